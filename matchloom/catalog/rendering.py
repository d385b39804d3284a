"""Captured pages rendered from table rows.

The tests and the registered queries need list pages, replay payloads, boards and
profiles whose right reading is known. Each input row becomes one battle; every value
and every defect is a fixed function of its key, so the same functions state what the
extraction must give back. Work and volume grow with the input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = "http://corpus.example"
BATTLES_PER_PAGE = 25
ROWS_PER_TASK = 5_000  # a task's pages are one Arrow batch, held whole by its Python worker


def tasks_for(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> int:
    """In how many tasks rows are rendered. Few input bytes become many page bytes, so their number follows the
    count of rows (read from the files' footers), and adaptive execution leaves it alone."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // per_task))


def _slug(side: int, j: str) -> str:
    base = f"'card' || ((k * 3 + {side} * 5 + {j} * 13) % 104)"
    return (
        f"{base} || CASE (k + {j} + {side}) % 9 WHEN 0 THEN '-ev1' WHEN 1 THEN '-hero' ELSE '' END"
    )


def _base(side: int, j: str) -> str:
    return f"'card' || ((k * 3 + {side} * 5 + {j} * 13) % 104)"


def _deck_list(side: int) -> str:
    return f"array_join(transform(sequence(0, 7), j -> {_slug(side, 'j')}), ',')"


def _tag(name: str, attributes: dict[str, str], inside: str | None = None) -> str:
    """SQL text of an element: attribute values and content are SQL expressions."""
    opened = f"'<{name}'" + "".join(f" || ' {k}=\"' || {v} || '\"'" for k, v in attributes.items()) + " || '>'"
    return opened if inside is None else f"{opened} || {inside} || '</{name}>'"


def _seat(side: int, tag: str) -> str:
    """One player's part of a round: tower, cards, name."""
    level = _tag("em", {"class": "'card-level'"}, "'Lvl ' || (9 + (k + j) % 8)")
    if side == 0:
        level = f"CASE WHEN k % 10 = 3 AND j = 0 THEN '' ELSE {level} END"
    image = _tag("img", {"data-card-key": _slug(side, "j"), "class": "'deck_card'"})
    card = _tag("p", {}, f"{level} || {_tag('u', {}, image)}")
    cards = f"array_join(transform(sequence(0, 7), j -> {card}), ' ')"
    tower = _tag("td", {"class": "'deck_tower_card__container'"},
                 _tag("b", {"class": "'level'"}, f"'Keep, Lvl ' || (14 + (k + {side}) % 3)") + " || "
                 + _tag("img", {"class": "'deck_card_key_tower' || (k % 4) || ' deck_card'"}))
    deck = _tag("td", {}, _tag("div", {"id": f"'deck_' || {tag}"}, cards))
    name = _tag("th", {}, _tag("a", {"href": f"'{BASE}/player/' || {tag} || '/battles'", "class": "'player_name_header'"}, tag))
    return _tag("tr", {}, f"{tower} || {deck} || {name}")


def battle_facts(orders: DataFrame) -> DataFrame:
    """Facts of one battle per order row."""
    return orders.selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "unix_timestamp(o_orderdate) + o_orderkey % 1000 AS ts"
    ).selectExpr(
        "*", "k div 25 AS page_no", "'B' || k AS tag",
        "'OWN' || (k div 25) AS owner", "'OPP' || c AS rival",
    )


def _button(team: str, opponent: str, team_crowns: str, opponent_crowns: str) -> str:
    return (
        "'<button class=\"ui replay_button\" data-index=\"' || (1000000 + k) || '\" data-replay=\"' || tag || "
        f"'\" data-team-tags=\"' || {team} || '\" data-opponent-tags=\"' || {opponent} || "
        "'\" data-draft=\"' || CASE WHEN k % 17 = 5 THEN 1 ELSE 0 END || "
        f"'\" data-team-crowns=\"' || {team_crowns} || '\" data-opponent-crowns=\"' || {opponent_crowns} || '\"></button>'"
    )


_TIME_ATTRIBUTE = "CASE k % 5 WHEN 0 THEN (ts * 1000) || '' WHEN 1 THEN '' WHEN 2 THEN ts || '.0' ELSE ts || '' END"
_POPUP = (
    "CASE WHEN k % 5 IN (1, 3) THEN '<div class=\"battle-timestamp-popup\" data-content=\"' || "
    "date_format(timestamp_seconds(ts), 'yyyy-MM-dd HH:mm:ss') || ' UTC\"></div>' ELSE '' END"
)
_KING = "CASE WHEN k % 2 = 0 THEN 7728 ELSE 5000 + k % 100 END"


def _towers(first: str, second: str) -> str:
    """Tower health at the end; the first side's total is at times off by one."""
    values = {}
    for name, extra in ((first, "CASE WHEN k % 19 = 7 THEN 1 ELSE 0 END"), (second, "0")):
        parts = {"total": f"({_KING}) + k % 3000 + k % 7 + {extra}", "princess1": "k % 7", "princess0": "k % 3000", "king": _KING}
        values |= {f"data-{name}-{part}": f"({value})" for part, value in parts.items()}
    return _tag("i", {"class": "'hp-both-popup'", **values}, "''")


def _block(mirrored: bool) -> str:
    """A battle: its mode and towers, the round as a table, then a footer of buttons."""
    team, opponent = ("rival", "owner") if mirrored else ("owner", "rival")
    s, o = (1, 0) if mirrored else (0, 1)
    crowns = ("k % 4", "(k + 1) % 3")
    decks = _tag("button", {
        "data-game-mode-id": "(72000000 + k % 5)", "data-players": "'1v1'", "data-opponent-deck": _deck_list(o),
        "data-team-deck": f"CASE WHEN k % 31 = 8 THEN 'zzz' ELSE {_deck_list(s)} END", "data-index": "(1000000 + k)", "class": "'matchup_button'"}, "'decks'")
    footer = f"{_button(team, opponent, *(crowns[::-1] if mirrored else crowns))} || CASE WHEN k % 23 = 9 THEN '' ELSE {decks} END"
    parts = [
        _tag("header", {}, f"{_POPUP} || " + _tag("h4", {"class": "'game_mode_header'"}, "CASE WHEN k % 13 = 4 THEN '2v2' ELSE 'Ranked' END")),
        _towers("oppo", "team") if mirrored else _towers("team", "oppo"),
        _tag("table", {"class": "'battle-team-segment-container'"}, f"{_seat(s, team)} || {_seat(o, opponent)}"),
        _tag("footer", {}, footer),
    ]
    attributes = {"data-timestamp": _TIME_ATTRIBUTE, "data-battle-type": "CASE WHEN k % 29 = 6 THEN 'riverRaceDuel' ELSE 'trail' END", "class": "'battle_list_battle'"}
    return _tag("article", attributes, " || ".join(parts))


def list_pages(orders: DataFrame, mirrored: bool = False, tasks: int | None = None) -> DataFrame:
    """Owner pages of up to 25 battles; ``mirrored`` shows them from the rivals' side. With a number of tasks the facts
    are dealt by page before they are rendered, so that no markup is shuffled."""
    prefix = "RIV" if mirrored else "OWN"
    team, opponent = ("rival", "owner") if mirrored else ("owner", "rival")
    facts = battle_facts(orders)
    html = (facts if tasks is None else facts.repartition(tasks, "page_no")).select(
        "k", "page_no",
        F.expr(f"CASE WHEN k % 37 = 11 THEN NULL ELSE {_block(mirrored)} END").alias("block"),
        F.expr(f"CASE WHEN k % 37 = 11 THEN {_button(team, opponent, 'k % 4', '(k + 1) % 3')} END").alias("bare"),
    )
    # A page holds the 25 keys of its number, whatever the table's size.
    grouped = html.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("k", "block", "bare"))).alias("parts"), F.min("k").alias("low")
    )
    pager = (
        "CASE page_no % 3 WHEN 1 THEN '' WHEN 2 THEN "
        f"'<a class=\"item\" href=\"/player/{prefix}' || page_no || '/battles/history?before=' || (low + 2000000000000) || '\"><i class=\"angle left icon\"></i></a>' "
        "ELSE '' END || '<a class=\"item ' || CASE page_no % 3 WHEN 1 THEN 'disabled' ELSE '' END || "
        f"'\" href=\"/player/{prefix}' || page_no || '/battles/history?before=' || (low + 1000000000000) || '&amp;\"><i class=\"angle right icon\"></i></a>'"
    )
    return grouped.select(
        F.col("page_no").alias("seq"), "page_no",
        F.expr(f"'{BASE}/player/{prefix}' || page_no || '/battles'").alias("url"),
        F.lit(200).alias("status"),
        F.concat(
            F.lit('<html><body><div class="battle_list_container">'),
            F.array_join(F.transform("parts", lambda p: F.coalesce(p["block"], F.lit(""))), ""),
            F.lit("</div>"),
            F.array_join(F.transform("parts", lambda p: F.coalesce(p["bare"], F.lit(""))), ""),
            F.expr(pager), F.lit("</body></html>"),
        ).alias("body"),
    )


def _marker(j: str, side: int, color: str, letter: str) -> str:
    orientation = f"CASE WHEN k % 21 = 4 AND {j} = 3 THEN '' ELSE ((k + {j}) % 2) || '' END"
    tick = (
        f"CASE WHEN k % 22 = 5 AND {j} = 2 THEN 'x' WHEN k % 33 = 3 AND {j} = 5 THEN (100 + k % 5) || '' "
        f"ELSE (20 * ({j} + 1) + k % 5) || '' END"
    )
    return (
        f"'<div class=\"{color} marker\" data-x=\"' || ((k * 37 + {j} * 1130) % 18001) || '\" data-y=\"' || "
        f"((k * 91 + {j} * 2050) % 32001) || '\" data-i=\"' || {orientation} || '\" data-c=\"' || {_base(side, j)} || "
        f"'\" data-t=\"' || {tick} || '\" data-s=\"{letter}\"></div>'"
    )


def replay_payloads(orders: DataFrame) -> DataFrame:
    """One replay response per order: 8 + 8 plays, at times an ability, two tables."""
    plays = (
        f"array_join(transform(sequence(0, 7), j -> {_marker('j', 0, 'blue', 't')} || {_marker('j', 1, 'red', 'o')}), '')"
    )
    ability = (
        "CASE WHEN k % 6 = 0 THEN '<div class=\"blue marker\" data-x=\"None\" data-y=\"None\" data-c=\"_invalid\" "
        "data-t=\"300\" data-s=\"t\"></div>' ELSE '' END"
    )

    def table(total: str, ability_count: str) -> str:
        return (
            "'<table class=\"ui replay_elixir_table\"><tr><td class=\"title\">Total</td><td class=\"right count\">' || "
            f"({total}) || '</td><td class=\"right elixir\">' || (20 + k % 9) || '.5</td></tr>"
            "<tr><td class=\"title\">Ability</td><td class=\"right count\">' || "
            f"({ability_count}) || '</td><td class=\"right elixir\">0</td></tr></table>'"
        )

    team_table = table("8 + CASE WHEN k % 27 = 2 THEN 1 ELSE 0 END", "CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END")
    duration = "CASE WHEN k % 25 = 7 THEN '6:40' ELSE '0:' || (30 + k % 20) END"
    html = (
        "'<div class=\"battle_replay\" data-tag=\"' || tag || '\">' || "
        f"{plays} || {ability} || {team_table} || {table('8 + CASE WHEN k % 53 = 11 THEN 1 ELSE 0 END', '0')} || "
        f"'<div class=\"marker end_time\">' || {duration} || '</div><em>7:07</em></div>'"
    )
    payload = F.when(F.expr("k % 41 = 8"), F.lit('{"success": false, "html": "requires login"}')).when(
        F.expr("k % 43 = 9"), F.lit('{"success": true, "html": "<p>Replay not found</p>"}')
    ).when(F.expr("k % 47 = 10"), F.lit("<html>checking your browser</html>")).otherwise(
        F.to_json(F.struct(F.lit(True).alias("success"), F.expr(html).alias("html")))
    )
    wrapped = F.when(F.expr("k % 3 = 1"), F.concat(
        F.lit("<html><body><pre>"),
        F.replace(F.replace(F.replace(payload, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")),
        F.lit("</pre></body></html>"))).otherwise(payload)
    return battle_facts(orders).select(
        F.col("k").alias("seq"), F.col("tag").alias("battle_tag"),
        F.expr(f"'{BASE}/data/replay?tag=' || tag || '&team_tags=' || owner || '&opponent_tags=' || rival").alias("url"),
        F.lit(200).alias("status"), wrapped.alias("body"),
    )


def board_pages(customers: DataFrame, season: str, per_page: int = 100) -> DataFrame:
    """Ranking boards: customer keys in rank order, 100 a page."""
    rows = customers.selectExpr(
        f"c_custkey div {per_page} AS page_no", "c_custkey + 1 AS rank", "'TAG' || c_custkey AS tag"
    )
    grouped = rows.groupBy("page_no").agg(F.array_sort(F.collect_list(F.struct("rank", "tag"))).alias("rows"))
    return grouped.select(
        F.col("page_no").alias("seq"),
        F.concat(F.lit(f"{BASE}/players/leaderboard/season/{season}?page="), F.col("page_no")).alias("url"),
        F.concat(
            F.lit(f"<html><body><h1> Top Global Players for Season {season} </h1>"),
            F.lit("<a href=\"/players/leaderboard/de\">DE</a><a href=\"/players/leaderboard/fr\">FR</a>"),
            F.lit("<script>initRoster($('#roster'), "), F.to_json("rows"), F.lit(", {});</script></body></html>"),
        ).alias("body"),
    )


def profile_pages(customers: DataFrame) -> DataFrame:
    """Player profiles with three past seasons and one badge of someone else."""
    popup = (
        "'<div data-html=\"&lt;div class=&quot;hist_heatmap__popup_rank&quot;&gt;' || format_number({rank}, 0) || "
        "'&lt;/div&gt;&lt;div class=&quot;hist_heatmap__popup_season&quot;&gt;{season}&lt;/div&gt;\"></div>'"
    )
    popups = " || ".join(
        popup.format(rank=f"(1 + (c_custkey * {m}) % 12000)", season=s)
        for m, s in ((7919, "2024-03"), (104729, "2024-05"), (1299709, "2024-09"))
    )
    return customers.select(
        F.col("c_custkey").alias("seq"), F.expr("'TAG' || c_custkey").alias("player"),
        F.expr(f"'{BASE}/player/TAG' || c_custkey").alias("url"),
        F.expr(
            "'<html><body><h1>Name</h1><h2>#TAG' || c_custkey || '</h2><div class=\"player__ladder_history_container\">' || "
            + popups + " || '</div><div data-html=\"1 2024-06\">badge</div></body></html>'"
        ).alias("body"),
    )
