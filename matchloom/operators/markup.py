"""Nested page markup to flat text rows, in Arrow batches.

Only what needs an element tree happens here: which deck belongs to which player,
which level label to which card. Values leave as raw text; every rule about them is a
Spark expression elsewhere.
"""

from __future__ import annotations

import json
import re
import sys
from bisect import bisect_right
from collections import defaultdict
from html import unescape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from matchloom import values as V

# Ship this module and the values it names with the tasks: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(V)

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Quoted values may hold a >; the runs are possessive, so an unterminated quote ends the
# attempt at once instead of trying every way to split what stands before it. Groups: an opened
# name and its attributes, or a closed name; a comment has none.
_REST = r"""[^"'>]*+(?:(?:"[^"]*+"|'[^']*+')[^"'>]*+)*+"""
_TAG = re.compile(rf"<(?:([A-Za-z][^\s/>]*+)({_REST})>|/([A-Za-z][^\s/>]*+){_REST}>|!--.*?-->)", re.S)
_GROUPS = _TAG.groups + 1
_RAW_TEXT = re.compile(r"(<(script|style)\b[^>]*>)(.*?)(?=</\2|\Z)", re.S | re.I)
_CLASS = re.compile(r"""(?:^|\s)class="([^"&]*)["]""")
_CARD_KEY = re.compile(r"""(?:^|\s)data-card-key="([^"&]*)["]""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"""\s*([^\s=/"'>]+)\s*=\s*""")
_KEPT = 4096  # texts that a memo holds before it is begun anew
_names: dict[str, str | None] = {}
_classes_of: dict[str, frozenset[str] | tuple] = {}
_cards: dict[str, str | None] = {}


def _name(text):
    """The attribute that a text before a quoted value names, or None if it holds anything else."""
    found = _NAME.fullmatch(text)
    if len(_names) >= _KEPT:
        _names.clear()
    _names[text] = name = found and found[1].lower()
    return name


def _attributes(raw):
    # Names with values in double quotes, each once, are told by the quotes; anything else is scanned.
    parts = raw.split('"')
    if len(parts) % 2 and not parts[-1].strip(" /"):
        names = [_names[p] if p in _names else _name(p) for p in parts[:-1:2]]
        attrs = dict(zip(names, parts[1::2]))
        if len(attrs) == len(names) and None not in attrs:
            return {n: unescape(v) if "&" in v else v for n, v in attrs.items()} if "&" in raw else attrs
    attrs = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), "".join(values)
        if name not in attrs:
            attrs[name] = unescape(value) if "&" in value else value
    return attrs


def _classes(raw):
    own = ()
    if "class" in raw or "CLASS" in raw:
        plain = _CLASS.search(raw)
        own = frozenset((plain[1] if plain else _attributes(raw).get("class") or "").split())
    if len(_classes_of) >= _KEPT:
        _classes_of.clear()
    _classes_of[raw] = own
    return own


class _Page:
    """A page's elements as parallel lists in page order; a node is a place in them, the root is 0.

    The descendants of a node are those behind it up to ``last``. ``pieces`` are the texts between the page's tags; a node's
    inner text and tags are the pieces from ``start`` on before ``stop`` and what stands between them.
    """

    __slots__ = ("body", "tag", "raw", "parent", "last", "pieces", "start", "stop", "spots", "by_class")

    def __init__(self, body):
        self.body, self.by_class, self.spots = body, defaultdict(list), None
        scanned = body
        if "<script" in body or "<style" in body:
            # Script and style text is no markup; blank it out for the tag scan only. Inner text is then found by place.
            scanned = _RAW_TEXT.sub(lambda m: m[1] + " " * len(m[3]), body)
            self.spots = [(m.start(), m.end()) for m in _TAG.finditer(scanned)]
        parts = _TAG.split(scanned)
        opened, ended = parts[1::_GROUPS], parts[3::_GROUPS]
        self.pieces = parts[::_GROUPS]
        self.tag = tags = ["", *[t.lower() for t in opened if t is not None]]
        self.raw = ["", *[r for r in parts[2::_GROUPS] if r is not None]]
        self.start = [0, *[i for i, t in enumerate(opened, 1) if t is not None]]
        self.stop = stops = self.start.copy()
        self.last = lasts = list(range(len(tags)))
        self.parent = parents = [-1] * len(tags)
        raws, by_class, open_nodes, node, parent = self.raw, self.by_class, [0], 0, 0
        for i, (name, close) in enumerate(zip(opened, ended), 1):
            if close is None:
                if name is None:
                    continue
                node += 1
                parents[node], raw = parent, raws[node]
                if raw:
                    names = _classes_of.get(raw)
                    for own in _classes(raw) if names is None else names:
                        by_class[own].append(node)
                    if raw[-1] == "/":
                        continue
                if tags[node] not in _VOID:
                    open_nodes.append(node)
                    parent = node
            elif tags[parent] == close:
                lasts[parent], stops[parent] = node, i
                open_nodes.pop()
                parent = open_nodes[-1]
            else:
                close = close.lower()
                if any(tags[n] == close for n in open_nodes):
                    while True:
                        inner = open_nodes.pop()
                        lasts[inner], stops[inner] = node, i
                        if tags[inner] == close:
                            break
                    parent = open_nodes[-1]
        for inner in open_nodes:
            lasts[inner], stops[inner] = node, len(self.pieces)

    def attrs(self, node):
        return _attributes(self.raw[node])

    def walk(self, node=0):
        return range(node + 1, self.last[node] + 1)

    def find(self, node, name, tag=None):
        """Descendants of a class, in page order."""
        nodes = self.by_class.get(name)
        if not nodes:
            return []
        low = bisect_right(nodes, node)
        found = nodes[low:bisect_right(nodes, self.last[node], lo=low)]
        return found if tag is None else [n for n in found if self.tag[n] == tag]

    def first(self, node, name):
        """The first descendant of a class, or None."""
        nodes = self.by_class.get(name)
        low = bisect_right(nodes, node) if nodes else 0
        return nodes[low] if nodes and low < len(nodes) and nodes[low] <= self.last[node] else None

    def inner(self, node):
        """What stands between a node's tags, of a page that has script or style text."""
        start, stop = self.start[node], self.stop[node]
        if stop == start and node:  # void, or never opened
            return ""
        return self.body[self.spots[start - 1][1] if start else 0:self.spots[stop - 1][0] if stop <= len(self.spots) else len(self.body)]

    def text(self, node):
        if self.spots is not None:
            inner = self.inner(node)
            pieces = _TAG.sub("\0", inner).split("\0") if "<" in inner else [inner]
        else:
            pieces = self.pieces[self.start[node]:self.stop[node]]
            if len(pieces) == 1:
                if "&" not in pieces[0] and "\0" not in pieces[0]:
                    return pieces[0].strip()
                if "<" not in pieces[0]:
                    return unescape(pieces[0]).strip()
            pieces = "\0".join(pieces).split("\0")
        return "".join(unescape(p).strip() for p in pieces)


def _card(raw):
    """The card that an image's attributes name."""
    plain = _CARD_KEY.search(raw)
    if len(_cards) >= _KEPT:
        _cards.clear()
    _cards[raw] = slug = plain[1] if plain else _attributes(raw).get("data-card-key")
    return slug


def _deck(page, node, player, tower):
    cards, labels = [], {}
    for image in page.find(node, "deck_card", tag="img"):
        raw = page.raw[image]
        slug = _cards[raw] if raw in _cards else _card(raw)
        if slug:
            cards.append(slug)
            holder = page.parent[page.parent[image]]
            label = page.first(holder, "card-level") if holder >= 0 else None
            if label is not None:
                labels[slug] = page.text(label)
    level = None if tower is None else page.first(page.parent[tower], "level")
    return {
        "player_link": player,
        "cards": cards,
        "labels": labels,
        "tower_class": None if tower is None else " ".join(page.attrs(tower).get("class", "").split()),
        "tower_label": None if level is None else page.text(level),
    }


def _player(link):
    """The path part between "player" and "battles", if the link has it."""
    parts = link.split("/")
    at = parts.index("player") if "player" in parts else len(parts)
    return parts[at + 1] if len(parts) > at + 2 and parts[at + 2].startswith("battles") else ""


def _round(page, segment):
    towers = [
        image for box in page.find(segment, "deck_tower_card__container")
        for image in page.find(box, "deck_card", tag="img")
    ]
    decks = [
        n for n, tag in enumerate(page.tag[segment + 1:page.last[segment] + 1], segment + 1)
        if tag == "div" and "deck_" in page.raw[n] and page.attrs(n).get("id", "").startswith("deck_")]
    targets = [page.attrs(a).get("href", "") for a in page.find(segment, "player_name_header", tag="a")]
    links = [t for t in targets if _player(t)]
    links += [None] * len(decks)
    towers += [None] * len(decks)
    return [_deck(page, d, links[i], towers[i]) for i, d in enumerate(decks)]


def _battles(body: str) -> list[list[str | None]]:
    out, page = [], _Page(body)
    for block in page.find(0, "battle_list_battle"):
        matchups = {}
        for attrs in map(page.attrs, page.find(block, "matchup_button")):
            if attrs.get("data-index"):
                matchups[attrs["data-index"]] = attrs
        mode = page.first(block, "game_mode_header")
        popup = page.first(block, "battle-timestamp-popup")
        hp = page.first(block, "hp-both-popup")
        shared = {
            "block": page.attrs(block),
            "mode": None if mode is None else page.text(mode),
            "popup": None if popup is None else page.attrs(popup).get("data-content"),
            "hp": None if hp is None else page.attrs(hp),
            "rounds": [_round(page, s) for s in page.find(block, "battle-team-segment-container")],
        }
        for button in map(page.attrs, page.find(block, "replay_button")):
            matchup = matchups.get(button.get("data-index", ""))
            out.append([button.get("data-replay"), json.dumps({**shared, "button": button, "matchup": matchup})])
    return out


def _profile(body: str) -> str:
    page, popups = _Page(body), []
    for box in page.find(0, "player__ladder_history_container"):
        for node in page.walk(box):
            held = page.attrs(node).get("data-html") if "data-html" in page.raw[node] else None
            if held is not None:
                popup = _Page(held)
                rank, season = popup.first(0, "hist_heatmap__popup_rank"), popup.first(0, "hist_heatmap__popup_season")
                if rank is not None and season is not None:
                    popups.append({"rank": popup.text(rank), "season": popup.text(season)})
    return json.dumps({
        "headings": [page.text(n) for n in page.walk() if page.tag[n] in ("h1", "h2")],
        "popups": popups,
    })


def _roster_calls(text):
    """What follows the first comma of each roster call that names the roster box."""
    at = text.find(V.ROSTER_CALL)
    while at >= 0:
        comma = text.find(",", at)
        if comma < 0:
            return
        if V.ROSTER_BOX in text[at:comma]:
            yield text[comma + 1:].lstrip()
        at = text.find(V.ROSTER_CALL, comma)


def _board(body: str) -> str:
    page = _Page(body)
    heading = next((n for n in page.walk() if page.tag[n] == "h1"), None)
    arrays, broken = [], False
    for script in (n for n in page.walk() if page.tag[n] == "script"):
        text = page.inner(script)
        for rest in _roster_calls(text):
            try:
                arrays.append(json.JSONDecoder().raw_decode(rest)[0])
            except ValueError:
                broken = True
    return json.dumps({
        "heading": None if heading is None else page.text(heading),
        "broken": broken or not all(
            isinstance(a, list) and all(isinstance(r, dict) for r in a) for a in arrays),
        "rows": [r for a in arrays if isinstance(a, list) for r in a if isinstance(r, dict)],
    })


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def battle_items(bodies: pd.Series) -> pd.Series:
    """The battle's tag and a JSON text per replay button inside a battle block, in page order."""
    return bodies.map(lambda b: _battles(b) if b else [])


@F.pandas_udf(StringType())
def profile_item(bodies: pd.Series) -> pd.Series:
    """Headings and ranking-history popups of a profile page, as JSON text."""
    return bodies.map(lambda b: _profile(b or ""))


@F.pandas_udf(StringType())
def board_item(bodies: pd.Series) -> pd.Series:
    """Heading and embedded ranking rows of a leaderboard page, as JSON text."""
    return bodies.map(lambda b: _board(b or ""))
