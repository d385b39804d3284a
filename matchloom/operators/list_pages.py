"""List pages to battles: one row per battle with its metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import values as V
from matchloom.functions import text as X
from matchloom.functions.expr import let, once
from matchloom.functions import times as T
from matchloom.functions import urls as U
from matchloom.operators import markup, select

_HP_NAMES = ("king", "princess0", "princess1", "total")
_ROUNDS = (
    "array<array<struct<player_link: string, cards: array<string>, labels: map<string,string>, "
    "tower_class: string, tower_label: string>>>"
)
_ITEM = (
    "block map<string,string>, mode string, popup string, hp map<string,string>, "
    f"button map<string,string>, matchup map<string,string>, rounds {_ROUNDS}"
)


def unique_captures(pages: DataFrame, seq: str = "seq") -> DataFrame:
    """One capture per (url, body), the earliest. Captures are compared by digests; the join hashes these narrow rows, so
    that bodies are moved at most once and never sorted."""
    winners = (
        pages.select("url", F.sha2("body", 256).alias("body_sha"), seq)
        .groupBy("url", "body_sha").agg(F.min(seq).alias(seq))
    )
    return pages.join(winners.hint("shuffle_hash"), ["url", seq], "inner")


def outcome(status: Column, body: Column) -> Column:
    """What a captured response is, from its status and body."""
    low = F.lower(body)
    payload_failed = body.rlike(r'"success"\s*:\s*false')
    login = low.contains("requires login") | body.contains("需要登录")
    challenge = low.rlike("cloudflare|challenge|cf_clearance|turnstile")
    return (
        F.when(status == 404, F.lit("not_found"))
        .when(status == 429, F.lit("rate_limited"))
        .when(status == 403, F.lit("forbidden"))
        .when((status >= 500) & (status < 600), F.lit("server_error"))
        .when(status != 200, F.lit("unexpected_status"))
        .when(payload_failed & login, F.lit("login_required"))
        .when(payload_failed, F.lit("refused"))
        .when(low.contains("replay not found"), F.lit("replay_not_found"))
        .when(body.rlike(r"\breplay_button\b"), F.lit("ok"))
        .when(body.rlike(r'^\s*\{'), F.lit("ok"))
        .when(challenge, F.lit("challenge"))
        .when(low.contains("battle_list_container"), F.lit("no_battles"))
        .otherwise(F.lit("unrecognized"))
    )


def failure_class(outcome_name: Column) -> Column:
    """Counter an outcome feeds."""
    return (
        F.when(outcome_name.isin("ok", "no_battles", "replay_not_found"), F.lit("success"))
        .when(outcome_name.isin("forbidden", "challenge"), F.lit("challenge"))
        .when(outcome_name.isin("rate_limited", "refused"), F.lit("rate_limited"))
        .when(outcome_name == "login_required", F.lit("auth_failure"))
        .when(outcome_name == "not_found", F.lit("not_found"))
        .otherwise(F.lit("error"))
    )


def player_missing(body: Column, tag: Column) -> Column:
    """The page says that exactly the requested player does not exist."""
    header = F.regexp_extract(
        body, r'(?s)class="[^"]*\bnegative\b[^"]*\bmessage\b[^"]*".*?class="[^"]*\bheader\b[^"]*"[^>]*>(.*?)<', 1)
    said = F.btrim(F.regexp_replace(header, r"\s+", " "))
    return said == F.concat(F.lit("Player tag #"), tag, F.lit(" not found (404)"))


# -- decks and rounds --------------------------------------------------------


def _deck_record(deck: Column) -> Column:
    slugs = deck["cards"]
    number = lambda label: F.regexp_extract(label, "([0-9]+)", 1).try_cast("int")
    parsed = F.map_filter(
        F.transform_values(deck["labels"], lambda _, v: number(v)), lambda _, v: v.isNotNull())
    own = F.filter(F.split(F.coalesce(deck["tower_class"], F.lit("")), r"\s+"), lambda c: c.startswith(V.TOWER_CLASS))
    tower = F.coalesce(F.substring(F.get(own, F.lit(0)), len(V.TOWER_CLASS) + 1, (1 << 31) - 1), F.lit(""))
    behind = F.ltrim(F.substring_index(F.coalesce(deck["tower_label"], F.lit("")), V.LEVEL_WORD, -1))
    tower_level = F.when(F.coalesce(deck["tower_label"], F.lit("")).contains(V.LEVEL_WORD), F.regexp_extract(behind, "^[0-9]+", 0))

    def with_cards(levels: Column) -> Column:
        deck_cards = F.transform(
            slugs,
            lambda s, i: F.struct(
                i.alias("slot"), s.alias("slug"), X.base_slug(s).alias("base_slug"),
                X.card_form(s).alias("form"), F.try_element_at(levels, s).alias("level"),
            ),
        )
        return let(deck_cards, lambda cards: record(levels, cards))

    def record(levels: Column, deck_cards: Column) -> Column:
        complete = (
            (F.size(slugs) == V.DECK_SIZE)
            & (F.size(F.array_distinct(F.transform(deck_cards, lambda c: c["base_slug"]))) == V.DECK_SIZE)
            & (F.size(F.array_distinct(slugs)) == V.DECK_SIZE)
            & ~F.exists(slugs, lambda s: s == V.INVALID_CARD)
            & (F.size(levels) == V.DECK_SIZE)
        )
        return F.struct(
            X.page_player(deck["player_link"]).alias("player_tag"),
            slugs.alias("full_deck"), deck_cards.alias("deck_cards"),
            F.when(tower != "", tower).alias("tower_troop"),
            tower_level.try_cast("int").alias("tower_troop_level"),
            levels.alias("card_levels"), complete.alias("complete"),
        )

    return let(parsed, with_cards)


def _side(records: Column, tags: Column) -> Column:
    """Records of the named players, in tag order; of a player's records the last."""
    found = F.transform(
        tags, lambda t: F.try_element_at(F.filter(records, lambda r: r["player_tag"] == t), F.lit(-1)))
    return F.filter(found, lambda r: r.isNotNull())


def _rounds(raw: Column, team: Column, opponent: Column) -> Column:
    def one(decks: Column) -> Column:
        return let(
            F.transform(decks, _deck_record),
            lambda records: F.struct(_side(records, team).alias("team"), _side(records, opponent).alias("opponent")),
        )

    return F.filter(F.transform(raw, one), lambda r: (F.size(r["team"]) > 0) | (F.size(r["opponent"]) > 0))


def _final_hp(hp: Column) -> Column:
    def side(prefix: str) -> tuple[Column, Column]:
        v = {n: X.digits_to_int(hp[f"data-{prefix}-{n}"]) for n in _HP_NAMES}
        valid = v["total"] == v["king"] + v["princess0"] + v["princess1"]
        return F.struct(*[v[n].alias(n) for n in _HP_NAMES]), F.coalesce(valid, F.lit(False))

    team, team_ok = side("team")
    opponent, opponent_ok = side("oppo")
    return F.when(
        team_ok & opponent_ok,
        F.struct(team.alias("team"), opponent.alias("opponent"), F.lit(V.HP_FROM_POPUP).alias("provenance")),
    )


# -- completeness flags --------------------------------------------------------


def _players(rounds: Column) -> Column:
    return F.flatten(F.transform(rounds, lambda r: F.concat(r["team"], r["opponent"])))


def battle_complete(rounds: Column, team_tags: Column, opponent_tags: Column) -> Column:
    """Every round names everybody, each with a complete deck."""
    return (F.size(rounds) > 0) & F.forall(
        rounds,
        lambda r: (F.size(r["team"]) == F.size(team_tags))
        & (F.size(r["opponent"]) == F.size(opponent_tags))
        & F.forall(F.concat(r["team"], r["opponent"]), lambda p: p["complete"]),
    )


def towers_complete(rounds: Column) -> Column:
    return (F.size(rounds) > 0) & F.forall(
        _players(rounds),
        lambda p: F.coalesce((p["tower_troop"] != "") & (p["tower_troop_level"] > 0), F.lit(False)),
    )


def _base_set(cards: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(cards, X.base_slug)))


def decks_agree(rounds: Column, matchup_team: Column, matchup_opponent: Column) -> Column:
    """The deck beside the matchup button equals the embedded deck on both sides."""
    single = F.size(rounds) == 1

    def agrees(listed: Column, side: str) -> Column:
        players = F.get(rounds, F.lit(0))[side]
        embedded = F.when(single & (F.size(players) == 1), F.get(players, F.lit(0))["full_deck"])
        embedded = F.coalesce(embedded, F.array().cast("array<string>"))
        return (F.size(listed) == V.DECK_SIZE) & (_base_set(listed) == _base_set(embedded))

    return agrees(matchup_team, "team") & agrees(matchup_opponent, "opponent")


def normal_1v1(metadata: dict[str, Column]) -> Column:
    """One round, one player a side, eight distinct levelled cards each, known mode."""
    first = F.get(metadata["rounds"], F.lit(0))

    def deck_ok(side: str) -> Column:
        p = F.get(first[side], F.lit(0))
        deck = p["full_deck"]
        return (
            (F.size(deck) == V.DECK_SIZE)
            & (F.size(F.array_distinct(deck)) == V.DECK_SIZE)
            & ~F.exists(deck, lambda c: (c == "") | (c == V.INVALID_CARD))
            & (F.size(p["card_levels"]) == V.DECK_SIZE)
            & F.forall(deck, lambda c: F.try_element_at(p["card_levels"], c).isNotNull())
        )

    test = (
        metadata["complete"] & ~F.coalesce(metadata["draft"], F.lit(False))
        & (F.size(metadata["rounds"]) == 1)
        & (F.size(first["team"]) == 1) & (F.size(first["opponent"]) == 1)
        & deck_ok("team") & deck_ok("opponent")
        & (F.coalesce(metadata["battle_type"], F.lit("")) != V.DUEL_BATTLE_TYPE)
        & metadata["game_mode"].isin(V.NORMAL_MODES)
    )
    return F.coalesce(test, F.lit(False))


# -- pages to battles ----------------------------------------------------------


def replay_buttons(body: Column) -> Column:
    """Opening tags of the buttons that lead to replays."""
    return F.filter(X.tags(body, "button"), lambda b: X.has_class(b, V.REPLAY_BUTTON))


def raw_battles(pages: DataFrame) -> DataFrame:
    """First button per battle tag within each page, blocks before bare buttons."""
    blocks = F.transform(
        markup.battle_items(F.col("body")),
        lambda t: F.struct(t[0].alias("tag"), t[1].alias("item"), F.lit(None).cast("string").alias("bare")),
    )
    bare = F.transform(
        replay_buttons(F.col("body")),
        lambda b: F.struct(
            X.attribute(b, "data-replay").alias("tag"), F.lit(None).cast("string").alias("item"), b.alias("bare"),
        ),
    )
    first_of_tag = let(
        F.concat(blocks, bare),
        lambda found: let(
            F.transform(found, lambda x: F.coalesce(x["tag"], F.lit(""))),
            lambda tags: F.filter(
                found, lambda x, i: (F.get(tags, i) != "") & (F.array_position(tags, F.get(tags, i)) == i + 1)),
        ),
    )
    kept = [c for c in pages.columns if c != "body"]
    # The outer form keeps the optimizer from testing the array in a filter of its own,
    # which would parse every page twice.
    return (
        pages.select(*kept, F.posexplode_outer(first_of_tag).alias("position", "_x"))
        .filter(F.col("position").isNotNull())
        .select(*kept, "position", F.col("_x.tag").alias("battle_tag"), F.col("_x.item").alias("item"),
                F.col("_x.bare").alias("bare"))
    )


def battles(pages: DataFrame, base: str) -> DataFrame:
    """Battles of list pages (``url``, ``body``, any further columns) with metadata."""
    raw = raw_battles(pages)
    kept = [c for c in raw.columns if c not in ("item", "bare")]
    parsed = once(raw, {"i": F.from_json("item", _ITEM)})
    is_bare = F.col("bare").isNotNull()

    def button(name: str) -> Column:
        return F.when(is_bare, X.attribute(F.col("bare"), name)).otherwise(
            F.coalesce(F.col("i.button")[name], F.lit("")))

    matched = F.coalesce(
        (F.col("i.button")["data-index"] != "") & (F.col("i.button")["data-index"] == F.col("i.matchup")["data-index"]),
        F.lit(False))

    def listed_deck(name: str) -> Column:
        parts = F.split(F.coalesce(F.col("i.matchup")[name], F.lit("")), ",")
        return F.filter(F.transform(parts, lambda x: F.btrim(x)), lambda x: x != "")

    none = F.array().cast("array<string>")
    team, opponent = X.split_tags(button("data-team-tags")), X.split_tags(button("data-opponent-tags"))
    popup = T.popup_instant(F.col("i.popup"))
    epoch = F.coalesce(T.block_epoch(F.col("i.block")["data-timestamp"]), F.unix_timestamp(popup))
    step = parsed.select(
        *kept, "i", is_bare.alias("bare_button"), matched.alias("matched"),
        U.replay_url(base, F.col("battle_tag"), button("data-team-tags"), button("data-opponent-tags"),
                     button("data-team-crowns"), button("data-opponent-crowns"), F.col("url")).alias("replay_url"),
        F.when(is_bare, none).otherwise(team).alias("team_tags"),
        F.when(is_bare, none).otherwise(opponent).alias("opponent_tags"),
        F.when(~is_bare, X.digits_to_int(button("data-team-crowns"))).alias("team_crowns"),
        F.when(~is_bare, X.digits_to_int(button("data-opponent-crowns"))).alias("opponent_crowns"),
        F.when(~is_bare, button("data-draft") == "1").alias("draft"),
        F.when(matched, X.digits_to_int(F.col("i.matchup")["data-game-mode-id"])).alias("numeric_game_mode_id"),
        F.when(~is_bare, X.digits_to_int(button("data-index"))).alias("battle_index"),
        F.when(matched, F.lit(V.INDEX_FROM_BOTH)).alias("battle_index_provenance"),
        F.when(matched, F.col("i.matchup")["data-players"]).alias("matchup_players"),
        listed_deck("data-team-deck").alias("matchup_team_deck"),
        listed_deck("data-opponent-deck").alias("matchup_opponent_deck"),
        F.col("i.block")["data-battle-type"].alias("battle_type"),
        F.col("i.mode").alias("game_mode"),
        epoch.alias("timestamp"),
        F.coalesce(T.iso_utc(popup), T.epoch_to_iso(epoch)).alias("battle_time_utc"),
        F.when(popup.isNotNull(), F.lit(V.UTC_FROM_POPUP))
        .when(epoch.isNotNull(), F.lit(V.UTC_FROM_TIMESTAMP)).alias("battle_time_utc_provenance"),
        _final_hp(F.col("i.hp")).alias("final_tower_hp"),
    )
    empty = F.array().cast(_ROUNDS)
    rounds = F.coalesce(_rounds(F.col("i.rounds"), F.col("team_tags"), F.col("opponent_tags")), _rounds(empty, none, none))
    with_rounds = once(step, {"rounds": rounds}).drop("i")
    flagged = with_rounds.withColumns({
        "version_timestamp": F.col("timestamp"),
        "version_timestamp_provenance": F.when(~F.col("bare_button"), F.lit(V.TIME_FROM_LIST)),
        "numeric_game_mode_provenance": F.when(F.col("numeric_game_mode_id").isNotNull(), F.lit(V.MODE_FROM_MATCHUP)),
        "complete": battle_complete(F.col("rounds"), F.col("team_tags"), F.col("opponent_tags")),
        "deck_crosscheck_complete": decks_agree(
            F.col("rounds"), F.col("matchup_team_deck"), F.col("matchup_opponent_deck")),
        "towers_complete": towers_complete(F.col("rounds")),
        "schema_version": F.lit(V.METADATA_SCHEMA_VERSION),
        "source": F.lit(V.METADATA_SOURCE),
        "source_list_url": F.col("url"),
    })
    authoritative = (
        F.col("complete") & F.col("matched") & F.col("battle_index").isNotNull()
        & F.col("numeric_game_mode_id").isNotNull() & (F.col("matchup_players") == "1v1")
        & F.col("timestamp").isNotNull() & F.col("battle_time_utc").isNotNull()
        & F.col("deck_crosscheck_complete") & F.col("towers_complete") & F.col("final_tower_hp").isNotNull()
    )
    names = ("complete", "draft", "rounds", "battle_type", "game_mode")
    return (
        flagged.withColumn("authoritative_complete", F.coalesce(authoritative, F.lit(False)))
        .withColumn("normal_1v1", normal_1v1({n: F.col(n) for n in names}))
        .drop("matched", "towers_complete")
    )


def player_tags(body: Column) -> Column:
    """Players named by replay buttons, in page order, each once."""
    named = F.transform(
        replay_buttons(body),
        lambda b: F.concat(
            F.split(X.attribute(b, "data-team-tags"), ","), F.split(X.attribute(b, "data-opponent-tags"), ",")
        ),
    )
    return F.array_distinct(F.filter(F.transform(F.flatten(named), lambda t: F.btrim(t)), lambda t: t != ""))


def player_links(body: Column) -> Column:
    """Players linked from a board, then those of embedded ranking rows."""
    targets = F.transform(X.tags(body), lambda t: X.attribute(t, "href"))
    links = F.transform(F.filter(targets, lambda t: t.rlike("^/player/[A-Za-z0-9]{3,}$")), lambda t: F.substring_index(t, "/", -1))
    return F.array_distinct(F.concat(links, ranked_tags(body)))


def ranked_tags(body: Column) -> Column:
    """Tags of ranking rows embedded in a page: JSON objects that name a rank, bare or quoted, and right behind it a tag. Read by what stands
    between quotation marks."""
    def stripped(t: Column) -> Column:
        return F.btrim(t, F.lit(X.BLANKS))

    def tag_behind(parts: Column, i: Column) -> Column:
        at = lambda n: F.get(parts, n)
        next_ = stripped(at(i + 1))
        quoted = next_ == ":"
        bare = stripped(F.regexp_replace(F.regexp_replace(next_, "^:", ""), ",$", ""))
        rank = F.when(quoted, at(i + 2)).when(next_.startswith(":") & next_.endswith(","), bare)
        key = F.when(~quoted, i + 2).when(stripped(at(i + 3)) == ",", i + 4)
        tag = at(key + 2)
        named = (at(key) == "tag") & (stripped(at(key + 1)) == ":") & rank.rlike("^[0-9]+$") & tag.rlike("^[A-Za-z0-9]{3,}$")
        return F.when(named, tag)

    return let(F.split(body, '"'), lambda parts: F.filter(
        F.transform(parts, lambda p, i: F.when(p == "rank", tag_behind(parts, i))), lambda t: t.isNotNull()))


def _anchors(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(r"(?s)<a\b[^>]*>.*?</a>"), F.lit(0))


def _anchor_part(anchor: Column, name: str) -> Column:
    opening = F.regexp_extract(anchor, r"^<a\b[^>]*>", 0)
    return F.replace(F.regexp_extract(opening, rf'\b{name}\s*=\s*"([^"]*)"', 1), F.lit("&amp;"), F.lit("&"))


def _has_icon(anchor: Column, direction: str) -> Column:
    words = "".join(rf'(?=[^"]*\b{w}\b)' for w in ("angle", direction, "icon"))
    return anchor.rlike(rf'class="{words}[^"]*"')


def links(body: Column) -> Column:
    """Link targets of a page, in order."""
    return F.transform(_anchors(body), lambda a: _anchor_part(a, "href"))


def next_page(body: Column, base: str) -> Column:
    """Struct of the next history page's ``url`` and an ``error`` when the direction
    cannot be told. A link marked as forward wins over unmarked ones."""
    # A usable target holds this text, and decoding can't make it: the many other anchors are not looked into.
    links = F.transform(
        F.filter(_anchors(body), lambda a: a.contains("history?before=")),
        lambda a: F.struct(
            U.resolve(F.regexp_replace(_anchor_part(a, "href"), "&+$", ""), base).alias("url"),
            (
                _anchor_part(a, "href").contains("history?before=")
                & ~F.array_contains(F.split(_anchor_part(a, "class"), r"\s+"), "disabled")
                & ~_has_icon(a, "left")
            ).alias("usable"),
            (_has_icon(a, "right") | F.array_contains(F.split(_anchor_part(a, "rel"), r"\s+"), "next")).alias("forward"),
        ),
    )
    usable = F.filter(links, lambda x: x["usable"])
    forward = F.get(F.filter(usable, lambda x: x["forward"]), F.lit(0))["url"]
    plain = F.array_distinct(F.transform(usable, lambda x: x["url"]))
    return F.struct(
        F.coalesce(forward, F.when(F.size(plain) == 1, F.get(plain, F.lit(0)))).alias("url"),
        F.when(forward.isNull() & (F.size(plain) > 1), F.lit("ambiguous")).alias("error"),
    )


def edges(battle_rows: DataFrame) -> DataFrame:
    """(battle, side, player) edges of battles, players normalized."""
    sides = F.concat(
        F.transform("team_tags", lambda t: F.struct(F.lit("team").alias("side"), X.strip_tag(t).alias("player"))),
        F.transform("opponent_tags", lambda t: F.struct(F.lit("opponent").alias("side"), X.strip_tag(t).alias("player"))),
    )
    kept = [c for c in ("url", "seq") if c in battle_rows.columns]
    return battle_rows.select("battle_tag", *kept, F.explode(sides).alias("_e")).select(
        "battle_tag", *kept, "_e.side", "_e.player")


def distinct_battles(battle_rows: DataFrame, *order: str) -> DataFrame:
    """Each battle once, first sighting first."""
    return select.first_by(battle_rows, ["battle_tag"], *order)
