"""Replay payloads to events, tables and counts: row-wise, so nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import values as V
from matchloom.functions import coords as C
from matchloom.functions import text as X
from matchloom.functions.expr import let, once


_PRE = r"(?s)<pre[^>]*>(.*?)</pre>"
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&amp;", "&"))


def payload(body: Column) -> Column:
    """A response's JSON as a variant, null if it is none. A body that starts with markup holds the JSON in its first
    ``<pre>``, or else is what is left without tags. What holds raw markup is taken as it is; what holds none was escaped by the
    browser that wrapped it, so its entities are decoded. Text that is no JSON one way is tried the other way."""
    def inner(text: Column) -> Column:
        return let(F.get(F.regexp_extract_all(text, F.lit(_PRE), F.lit(1)), F.lit(0)), lambda pre: F.btrim(
            F.coalesce(pre, F.regexp_replace(text, "<[^>]+>", "")), F.lit(X.BLANKS)))

    def read(t: Column) -> Column:
        return F.try_parse_json(F.when(t != "", t))

    def decoded(t: Column) -> Column:
        for entity, char in _ENTITIES:
            t = F.replace(t, F.lit(entity), F.lit(char))
        return t

    def unescaped(t: Column) -> Column:
        return F.when(~t.contains("&"), read(t)).when(
            t.contains("<"), F.coalesce(read(t), read(decoded(t)))).otherwise(F.coalesce(read(decoded(t)), read(t)))

    return let(F.btrim(body, F.lit(X.BLANKS)), lambda text: F.when(
        text.startswith("<"), let(inner(text), unescaped)).otherwise(read(text)))


def unwrap(payloads: DataFrame) -> DataFrame:
    """Adds ``html`` and ``outcome`` (ok, not_json, refused, login_required,
    replay_not_found, not_object) to rows with a ``body``."""
    parsed = once(payloads, {"_j": payload(F.col("body"))})
    is_object = F.schema_of_variant("_j").startswith("OBJECT")
    html = F.try_variant_get("_j", "$.html", "string")
    refused = F.try_variant_get("_j", "$.success", "boolean") == F.lit(False)
    low = F.lower(F.coalesce(html, F.lit("")))
    outcome = (
        F.when(F.col("_j").isNull(), F.lit("not_json"))
        .when(~is_object, F.lit("not_object"))
        .when(refused & (low.contains("requires login") | low.contains("需要登录")), F.lit("login_required"))
        .when(refused, F.lit("refused"))
        .when(low.contains("replay not found"), F.lit("replay_not_found"))
        .otherwise(F.lit("ok"))
    )
    return once(once(parsed, {"html": html}), {"outcome": outcome}).drop("_j", "body")


def _marker(tag: Column, index: Column) -> Column:
    """One marker's raw fields, and why it cannot be kept exactly."""
    def raw(name: str) -> Column:
        return X.attribute(tag, name)

    return let(
        F.struct(
            index.cast("int").alias("marker_index"),
            F.when(X.attribute(tag, "class").startswith(V.MARKER_COLORS[0]), V.MARKER_COLORS[0]).otherwise(V.MARKER_COLORS[1]).alias("color"),
            raw("data-c").alias("card"), raw("data-x").alias("xs"), raw("data-y").alias("ys"),
            raw("data-t").alias("ts"), raw("data-s").alias("ss"), raw("data-i").alias("orientation"),
        ),
        _typed_marker,
    )


def _typed_marker(m: Column) -> Column:
    oriented = F.when(m["orientation"].isin("0", "1"), m["orientation"].cast("int"))
    typed = F.struct(
        X.digits_to_int(m["xs"]).alias("x"), X.digits_to_int(m["ys"]).alias("y"),
        X.digits_to_int(m["ts"]).alias("t"), oriented.alias("i"), (m["card"] == V.INVALID_CARD).alias("ability"),
    )
    return let(typed, lambda v: let(
        F.struct(
            C.oriented_x(v["x"], v["i"]).alias("x"), C.oriented_y(v["y"], v["i"]).alias("y"),
            (v["x"].isNotNull() | v["y"].isNotNull()).alias("spatial"),
        ),
        lambda o: _event(m, v, o),
    ))


def _event(m: Column, v: Column, o: Column) -> Column:
    ability, placed = v["ability"], ~v["ability"] | o["spatial"]
    halved = v["x"].isNull() | v["y"].isNull()
    error = (
        F.when(m["card"] == "", F.lit("card_missing"))
        .when(v["t"].isNull(), F.lit("tick_invalid"))
        .when(~m["orientation"].isin("", "0", "1"), F.lit("orientation_invalid"))
        .when(ability & o["spatial"] & halved, F.lit("ability_coordinate_partial"))
        .when(~ability & halved, F.lit("coordinate_missing"))
        .when(placed, C.orientation_error(v["x"], v["y"], v["i"]))
    )
    return F.struct(
        m["marker_index"].alias("marker_index"), m["color"].alias("color"),
        F.when(m["ss"] == "t", F.lit("team")).otherwise(F.lit("opponent")).alias("side"),
        ability.alias("ability"),
        F.when(~ability, m["card"]).alias("card"),
        C.seconds_of_tick(v["t"]).alias("time"), v["t"].alias("time_raw"),
        v["i"].alias("data_i"), v["x"].alias("x_raw"), v["y"].alias("y_raw"),
        F.when(ability & ~o["spatial"], F.lit("not_applicable")).otherwise(F.lit("resolved")).alias("coordinate_status"),
        F.when(placed, F.lit(V.ORIENTATION_ID)).alias("coordinate_provenance"),
        F.when(placed, C.transform_name(v["i"])).alias("coordinate_transform"),
        F.when(placed, o["x"]).alias("x"), F.when(placed, o["y"]).alias("y"),
        F.when(~ability, C.ratio_rounded(o["x"], V.ARENA_WIDTH, 4)).alias("x_norm"),
        F.when(~ability, C.ratio_rounded(o["y"], V.ARENA_HEIGHT, 4)).alias("y_norm"),
        F.when(~ability, C.ratio_rounded(o["x"], 1000, 1)).alias("tile_x"),
        F.when(~ability, C.ratio_rounded(o["y"], 1000, 1)).alias("tile_y"),
        error.alias("error"),
    )


def _table_rows(table: Column) -> Column:
    def cell(cells: Column, test) -> Column:
        """Text of the first cell whose class passes the test."""
        return F.coalesce(X.text_behind(F.get(F.filter(cells, lambda c: test(c["class"])), F.lit(0))["piece"]), F.lit(""))

    def row(tr: Column) -> Column:
        classed = F.transform(X.pieces(tr), lambda c: F.struct(X.attribute(c, "class").alias("class"), c.alias("piece")))
        return let(classed, lambda cells: F.struct(
            cell(cells, lambda c: c == "title").alias("title"),
            let(cell(cells, lambda c: c.contains("count")), X.digits_to_int).alias("count"),
            cell(cells, lambda c: c.contains("elixir")).try_cast("double").alias("elixir"),
        ))

    rows = F.transform(X.elements(table, "tr"), row)
    return F.filter(rows, lambda r: r["title"] != "")


def _as_map(rows: Column) -> Column:
    """Title to count and elixir; of equal titles the last row counts."""
    return F.map_from_entries(
        F.transform(
            F.array_distinct(F.transform(rows, lambda r: r["title"])),
            lambda t: F.struct(
                t.alias("key"),
                let(F.element_at(F.filter(rows, lambda r: r["title"] == t), -1),
                    lambda r: F.struct(r["count"].alias("count"), r["elixir"].alias("elixir"))).alias("value"),
            ),
        )
    )


def _assign_tables(tables: Column, team_plays: Column, opponent_plays: Column) -> Column:
    """Which table belongs to which side: by play count in page order, then by position."""
    start = F.struct(F.lit(None).cast("int").alias("team"), F.lit(None).cast("int").alias("opponent"))
    plays = F.struct(team_plays.alias("team"), opponent_plays.alias("opponent"))
    indexed = F.transform(
        tables,
        lambda t, i: F.struct(
            i.alias("i"),
            F.try_element_at(F.filter(t, lambda r: r["title"] == "Total"), F.lit(-1))["count"].alias("total"),
        ),
    )

    def step(s: Column, t: Column, n: Column) -> Column:
        is_team = F.coalesce(s["team"].isNull() & (t["total"] == n["team"]), F.lit(False))
        is_opponent = F.coalesce(s["opponent"].isNull() & (t["total"] == n["opponent"]), F.lit(False))
        return F.struct(
            F.when(is_team, t["i"]).otherwise(s["team"]).alias("team"),
            F.when(~is_team & is_opponent, t["i"]).otherwise(s["opponent"]).alias("opponent"),
        )

    chosen = let(plays, lambda n: F.aggregate(indexed, start, lambda s, t: step(s, t, n)))
    return let(chosen, lambda s: F.struct(
        F.get(tables, F.coalesce(s["team"], F.lit(0))).alias("team"),
        F.get(tables, F.coalesce(s["opponent"], F.lit(1))).alias("opponent"),
    ))


def _seconds(clock: Column) -> Column:
    parts = F.split(clock, ":")
    return F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int")


def duration_seconds(html: Column) -> Column:
    """The timeline's end mark; only pages without one fall back to the latest clock."""
    # Most pieces don't hold the mark's name at all: looking for it is cheaper than reading their classes.
    pieces = F.when(html.contains(V.END_MARK), X.pieces(html)).when(html.isNotNull(), F.array().cast("array<string>"))
    marked = F.transform(F.filter(pieces, lambda p: p.contains(V.END_MARK) & X.has_class(p, V.MARKER, V.END_MARK)), X.text_behind)
    ends = F.filter(F.transform(marked, lambda t: F.regexp_extract(t, "^" + V.CLOCK, 1)), lambda t: t != "")
    clocks = F.regexp_extract_all(html, F.lit(V.CLOCK), F.lit(1))
    return let(F.get(ends, F.lit(0)), lambda end: F.when(end.isNotNull(), _seconds(end)).otherwise(F.array_max(F.transform(clocks, _seconds))))


def side_of(items: Column, side: str) -> Column:
    return F.filter(items, lambda e: e["side"] == side)


def _card_counts(plays: Column, side: str) -> Column:
    return let(
        F.transform(side_of(plays, side), lambda p: p["card"]),
        lambda cards: F.map_from_entries(F.transform(
            F.array_distinct(cards), lambda c: F.struct(c, F.size(F.filter(cards, lambda x: x == c))))),
    )


def parse(payloads: DataFrame) -> DataFrame:
    """Replay documents of unwrapped payloads; ``parse_error`` marks unusable ones."""
    divs, tables = F.col("_divs"), X.elements(F.col("html"), "table")
    boxes = F.filter(divs, lambda t: t.contains(V.REPLAY_BOX) & X.has_class(t, V.REPLAY_BOX))
    tag = X.attribute(F.get(boxes, F.lit(0)), "data-tag")
    markers = F.filter(divs, lambda t: t.contains(V.MARKER) & X.attribute(t, "class").isin(*[f"{c} {V.MARKER}" for c in V.MARKER_COLORS]))
    tables = F.filter(tables, lambda t: F.get(X.tags(t, "table"), F.lit(0)).contains(V.ELIXIR_TABLE))
    found = once(once(payloads, {"_divs": X.tags(F.col("html"), "div")}), {
        "_markers": F.transform(markers, _marker),
        "_tables": F.transform(tables, _table_rows),
        "replay_tag": let(tag, lambda t: F.when(t != "", t)),
        "duration_seconds": duration_seconds(F.col("html")),
    }).drop("_divs", "html")
    split = once(found, {
        "card_plays": F.filter("_markers", lambda m: ~m["ability"]),
        "ability_plays": F.filter("_markers", lambda m: m["ability"]),
        "parse_error": F.get(F.filter(F.transform("_markers", lambda m: m["error"]), lambda e: e.isNotNull()), F.lit(0)),
    })
    placed = once(split, {"_t": _assign_tables(
        F.col("_tables"), F.size(side_of(F.col("card_plays"), "team")), F.size(side_of(F.col("card_plays"), "opponent")))})
    none = F.array().cast("array<struct<title:string,count:int,elixir:double>>")
    return placed.select(
        *[c for c in payloads.columns if c != "html"],
        "replay_tag", "card_plays", "ability_plays", "duration_seconds",
        F.struct(
            _as_map(F.coalesce("_t.team", none)).alias("team"),
            _as_map(F.coalesce("_t.opponent", none)).alias("opponent"),
        ).alias("elixir_stats"),
        F.struct(
            _card_counts(F.col("card_plays"), "team").alias("team"),
            _card_counts(F.col("card_plays"), "opponent").alias("opponent"),
        ).alias("card_counts"),
        C.orientation_contract().alias("orientation_contract"),
        "parse_error",
    )


def events(replays: DataFrame, *keys: str) -> DataFrame:
    """Plays and abilities as one command stream, one row per marker."""
    kinds = F.concat(
        F.transform("card_plays", lambda e: F.struct(F.lit("play").alias("event_kind"), e.alias("e"))),
        F.transform("ability_plays", lambda e: F.struct(F.lit("ability").alias("event_kind"), e.alias("e"))),
    )
    exploded = once(replays.select(*keys, "card_plays", "ability_plays"), {"_kinds": kinds}).select(*keys, F.explode("_kinds").alias("_k"))
    return exploded.select(*keys, "_k.event_kind", "_k.e.*").drop("ability", "error")


def upgrade_legacy(replays: DataFrame) -> DataFrame:
    """Schema 3 and 4 documents brought to the current version by re-deriving every
    coordinate from its raw values; ``upgrade_error`` says why one is refused."""
    def rederive(e: Column, ability: bool) -> Column:
        spatial = e["x_raw"].isNotNull() | e["y_raw"].isNotNull()
        placed = spatial if ability else F.lit(True)
        kind = "ability" if ability else "deployment"
        error = (
            F.when(e["time_raw"].isNull() | (e["time_raw"] < 0), F.lit(f"{kind}_exact_tick_missing"))
            .when(e["marker_index"].isNull() | (e["marker_index"] < 0), F.lit(f"{kind}_marker_index_missing"))
        )
        if ability:
            error = error.when(spatial & (e["x_raw"].isNull() | e["y_raw"].isNull()), F.lit("ability_partial_raw_coordinate"))
        error = error.when(
            placed & C.orientation_error(e["x_raw"], e["y_raw"], e["data_i"]).isNotNull(),
            F.concat(F.lit("raw_coordinate_upgrade_failed:"), C.orientation_error(e["x_raw"], e["y_raw"], e["data_i"])))
        x, y = C.oriented_x(e["x_raw"], e["data_i"]), C.oriented_y(e["y_raw"], e["data_i"])
        new = {
            "coordinate_provenance": F.when(placed, F.lit(V.ORIENTATION_ID)),
            "coordinate_transform": F.when(placed, C.transform_name(e["data_i"])),
            "x": F.when(placed, x), "y": F.when(placed, y),
            "coordinate_status": F.when(placed, F.lit("resolved")).otherwise(F.lit("not_applicable")),
        }
        if not ability:
            new |= {
                "x_norm": C.ratio_rounded(x, V.ARENA_WIDTH, 4), "y_norm": C.ratio_rounded(y, V.ARENA_HEIGHT, 4),
                "tile_x": C.ratio_rounded(x, 1000, 1), "tile_y": C.ratio_rounded(y, 1000, 1),
            }
        out = e
        for name, value in {**new, "error": error}.items():
            out = out.withField(name, value)
        return out

    def first_error(name: str) -> Column:
        return F.get(F.filter(F.transform(name, lambda e: e["error"]), lambda x: x.isNotNull()), F.lit(0))

    error = (
        F.when(~F.coalesce(F.col("source_schema_version").isin(*V.EXACT_LEGACY_VERSIONS), F.lit(False)),
               F.lit("source_schema_not_exact"))
        .when(F.col("card_plays").isNull() | F.col("ability_plays").isNull(), F.lit("exact_event_arrays_missing"))
    )
    staged = once(replays.withColumnRenamed("schema_version", "source_schema_version"), {
        "_refused": error,
        "card_plays": F.transform("card_plays", lambda e: rederive(e, False)),
        "ability_plays": F.transform("ability_plays", lambda e: rederive(e, True)),
    })
    return staged.withColumn(
        "upgrade_error", F.coalesce("_refused", first_error("card_plays"), first_error("ability_plays"))
    ).withColumns({
        "schema_version": F.lit(V.REPLAY_SCHEMA_VERSION),
        "orientation_contract": C.orientation_contract(),
    }).drop("_refused")
