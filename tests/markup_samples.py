"""Small pages put together from elements, with values of our own."""

from html import escape

TEAM = [f"t{i}" for i in range(8)]
RIVAL = [f"r{i}" for i in range(8)]
SITE = "http://site.example"


def el(name, classes="", *inside, **attributes):
    """One element; underscores in attribute names stand for dashes."""
    shown = {"class": classes, **{k.replace("_", "-"): v for k, v in attributes.items()}}
    opening = " ".join([name, *(f'{k}="{v if k == "href" else escape(str(v))}"' for k, v in shown.items() if v != "" or k != "class")])
    return f"<{opening}>" + ("" if name == "img" else "".join(inside) + f"</{name}>")


def player(tag, cards, tower_level=15, levels=True):
    def card(i, slug):
        label = el("p", "card-level", f"Lvl {10 + i}") if levels else ""
        return el("li", "", el("span", "", el("img", "deck_card", data_card_key=slug)), label)

    tower = el("section", "deck_tower_card__container",
               el("img", "deck_card deck_card_key_tower-a"), el("p", "level", f"Lvl {tower_level}"))
    deck = el("div", "", *[card(i, c) for i, c in enumerate(cards)], id=f"deck_{tag}")
    return el("article", "", tower, deck, el("a", "player_name_header", "name", href=f"{SITE}/player/{tag}/battles"))


HP = {"oppo": (7728, 0, 915), "team": (7728, 1400, 2210)}


def block(tag="M1", rounds=None, mode="1v1", kind="trail", team="ALPHA", rival="BRAVO", index="77", draft="0", timestamp="1800000000.0"):
    if rounds is None:
        rounds = [player(t, TEAM) for t in team.split(",")] + [player(t, RIVAL) for t in rival.split(",")]
    if all(isinstance(r, str) for r in rounds):
        rounds = [rounds]
    points = {}
    for side, (king, left, right) in HP.items():
        points |= {f"data_{side}_total": king + left + right, f"data_{side}_king": king, f"data_{side}_princess0": left, f"data_{side}_princess1": right}
    play = {"data_replay": tag, "data_index": index, "data_draft": draft, "data_team_tags": team, "data_opponent_tags": rival}
    decks = {"data_team_deck": ",".join(TEAM), "data_opponent_deck": ",".join(RIVAL)}
    return el(
        "div", "battle_list_battle",
        el("button", "replay_button", data_team_crowns=1, data_opponent_crowns=0, **play),
        el("button", "matchup_button", data_game_mode_id=501, data_players="1v1", data_index=index, **decks),
        el("h4", "game_mode_header", f"\n{mode}\n"),
        *[el("main", "battle-team-segment-container", *r) for r in rounds],
        el("b", "hp-both-popup", **points),
        el("i", "battle-timestamp-popup", data_content="2027-01-15 08:00 UTC"),
        data_timestamp=timestamp, data_battle_type=kind)


def marker(color, card, tick, side, x=1000, y=2000, i="1"):
    return el("div", f"{color} marker", data_t=tick, data_c=card, data_s=side, data_i=i, data_y=y, data_x=x)


def table(total, ability=0):
    def row(title, count, elixir):
        return el("tr", "", el("td", "count", str(count)), el("td", "elixir", elixir), el("td", "title", title))

    return el("table", "replay_elixir_table", row("Ability", ability, "0"), row("Total", total, "31"))


def replay(tag="M1", markers=None, tables=None, end="1:05"):
    if markers is None:
        markers = []
        for i in range(8):
            markers += [marker("blue", TEAM[i], 44 + 37 * i, "t"), marker("red", RIVAL[i], 61 + 37 * i, "o", 9500, 17250, "0")]
    tables = [table(8), table(8)] if tables is None else tables
    shown = [el("em", "", "9:41"), *tables, *markers]
    if end:
        shown.append(el("span", "marker end_time", end, title="end"))
    return el("div", "battle_replay", *shown, data_tag=tag)
