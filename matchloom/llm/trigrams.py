"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that any match must
contain. Documents are indexed shard by shard (a shard is one Arrow batch): postings lists of
document ordinals per trigram, kept for the trigrams that some query asks for. Queries intersect
and unite postings, and the regular expression runs on the candidates only. A rule without a
mandatory trigram (a bare character class) scans every document of the shard. A shard needs
nothing from another one, so nothing is shuffled and a lost executor repeats only its own shards.

Null or empty text has no spans. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

import numpy as np
from pyspark.sql import DataFrame

from matchloom.llm.base import FOLD, map_batches, ships

ships(__name__)

#: name, pattern, least length of the last group (of the match if there is none)
BASE_RULES = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]+", 20),
    ("hex", r"[0-9a-f]+", 24),
]
EXTRA_RULES = [
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    ("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,255}", 1),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9]+-[A-Za-z0-9-]+", 16),
    ("map_key", r"AIza[0-9A-Za-z_-]{35}", 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 24),
    ("pay_key", r"[rs]k_live_[0-9a-zA-Z]{24,99}", 1),
]

ALL = ("all",)
MAX_STRINGS = 64  # sets of exact strings larger than this become queries


def _both(*parts):
    flat = [q for p in parts for q in (p[1:] if p[0] == "and" else [p])]
    kept = list(dict.fromkeys(p for p in flat if p != ALL))
    return ALL if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def _either(*parts):
    kept = list(dict.fromkeys(parts))
    return ALL if ALL in kept or not kept else kept[0] if len(kept) == 1 else ("or", *kept)


def _holds(strings: set[str]):
    """The query for "one of these strings occurs"."""
    return _either(*[_both(*[("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in sorted(strings)])


class _Part:
    """What is known of the matches of a part: all of them (``exact``), or how they begin and end."""

    def __init__(self, exact=None, head=frozenset({""}), tail=frozenset({""}), query=ALL):
        self.exact, self.query = exact, query
        self.head, self.tail = (exact, exact) if exact is not None else (head, tail)

    def then(self, other: _Part) -> _Part:
        if self.exact is not None and other.exact is not None and len(self.exact) * len(other.exact) <= MAX_STRINGS:
            return _Part({a + b for a in self.exact for b in other.exact}, query=_both(self.query, other.query))
        seam = {a[-2:] + b[:2] for a in self.tail for b in other.head}
        def grown(whole, mine, theirs):
            made = {a + b for a in mine for b in theirs} if whole is not None else mine
            return made if len(made) <= MAX_STRINGS else mine
        return _Part(
            head=grown(self.exact, self.head, other.head),
            tail={a + b for a in self.tail for b in other.tail}
            if other.exact is not None and len(self.tail) * len(other.tail) <= MAX_STRINGS else other.tail,
            query=_both(self.query, other.query, _holds(self.tail), _holds(other.head), _holds(seam)))


def _folded(code: int) -> str:
    return chr(code).translate(FOLD)


def _analysed(nodes) -> _Part:
    out = _Part({""})
    for op, arg in nodes:
        if op is C.LITERAL:
            part = _Part({_folded(arg)})
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 8:
            part = _Part({_folded(a) for _, a in arg})
        elif op is C.SUBPATTERN:
            part = _analysed(arg[3])
        elif op is C.BRANCH:
            parts = [_analysed(x) for x in arg[1]]
            query = _either(*[p.query for p in parts])
            if all(p.exact is not None for p in parts):
                part = _Part(set().union(*[p.exact for p in parts]), query=query)
            else:
                part = _Part(head=set().union(*[p.head for p in parts]), tail=set().union(*[p.tail for p in parts]), query=query)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = arg
            part = _analysed(inner)
            if (low, high) == (0, 1) and part.exact is not None:
                part = _Part(part.exact | {""})
            elif low == 0:
                part = _Part()
            elif (low, high) != (1, 1):
                part = _Part(head=part.head, tail=part.tail, query=part.query)
        elif op is C.AT:
            part = _Part({""})
        else:
            part = _Part()
        out = out.then(part)
    return out


def trigram_query(pattern: str):
    """Boolean query, over lower-cased trigrams, that holds for every text the pattern matches in:
    ``("tri", t)``, ``("and", ...)``, ``("or", ...)``, or ``("all",)`` when nothing is mandatory."""
    part = _analysed(_parser.parse(pattern))
    return _both(part.query, _holds(part.head), _holds(part.tail))


def _trigrams(query) -> set[str]:
    return {query[1]} if query[0] == "tri" else set().union(*[_trigrams(q) for q in query[1:]], set())


def postings(texts: list[str], wanted: list[str]) -> dict[str, np.ndarray]:
    """Sorted ordinals of the texts that hold each wanted trigram, ASCII letters in either case."""
    parts = [t.translate(FOLD).encode() for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    if len(raw) < 3 or not wanted:
        return {t: np.zeros(0, np.int64) for t in wanted}
    codes = np.array([int.from_bytes(t.encode(), "big") for t in wanted])
    number = np.zeros(1 << 24, np.uint8 if len(wanted) < 255 else np.uint16)
    number[codes] = np.arange(1, len(wanted) + 1)
    code = raw[:-2].astype(np.int32) << 16
    code |= raw[1:-1].astype(np.int32) << 8
    code |= raw[2:]
    found = number[code]
    at = np.flatnonzero(found)
    doc = np.searchsorted(ends, at, side="right")
    inside = doc == np.searchsorted(ends, at + 2, side="right")
    pairs = np.unique(found[at[inside]].astype(np.int64) * (len(texts) + 1) + doc[inside])
    which, doc = np.divmod(pairs, len(texts) + 1)
    cut = np.searchsorted(which, np.arange(1, len(wanted) + 2))
    return {t: doc[cut[i]:cut[i + 1]] for i, t in enumerate(wanted)}


def candidates(query, lists: dict[str, np.ndarray], everything: np.ndarray) -> np.ndarray:
    """Ordinals of the texts for which the query holds."""
    if query[0] == "all":
        return everything
    if query[0] == "tri":
        return lists[query[1]]
    found = [candidates(q, lists, everything) for q in query[1:]]
    if query[0] == "or":
        return np.unique(np.concatenate(found))
    found.sort(key=len)
    out = found[0]
    for x in found[1:]:
        out = np.intersect1d(out, x, assume_unique=True)
    return out


def spans_of(matcher: re.Pattern, text: str, least: int) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches whose last group is long enough."""
    return [m.span() for m in matcher.finditer(text) if len(m[m.re.groups]) >= least]


def _matcher(pattern: str, least: int) -> re.Pattern:
    """A lone repeated class is searched at its least length: its matches are disjoint runs."""
    lone = re.fullmatch(r"\[[^\]]+\]\+", pattern)
    return re.compile(f"{pattern[:-1]}{{{least},}}" if lone else pattern, re.ASCII)


def _shard_scanner(rules):
    """A function from texts to their spans (start, order of the rule, kind, end), sorted."""
    plan = [(k, trigram_query(p), p, n) for k, p, n in rules]
    wanted = sorted(set().union(*[_trigrams(q) for _, q, _, _ in plan], set()))

    def found(texts: list[str]) -> list[list[tuple]]:
        lists, everything = postings(texts, wanted), np.arange(len(texts))
        spans = [[] for _ in texts]
        for order, (kind, query, pattern, least) in enumerate(plan):
            matcher = _matcher(pattern, least)
            for i in candidates(query, lists, everything):
                spans[i] += [(a, order, kind, b) for a, b in spans_of(matcher, texts[i], least)]
        return [sorted(x) for x in spans]

    return found


def scan(docs: DataFrame, rules: list[tuple[str, str, int]] = BASE_RULES + EXTRA_RULES) -> DataFrame:
    """``doc_id`` and ``found``, an array of (kind, start, end) in code points, ordered by start,
    then by the order of the rules. Every document gives one row."""
    found = _shard_scanner(rules)

    def shard(columns):
        spans = found([t or "" for t in columns["text"]])
        return {"doc_id": columns["doc_id"],
                "found": [[{"kind": k, "start": a, "end": b} for a, _, k, b in x] for x in spans]}

    return map_batches(docs.select("doc_id", "text"), shard,
                       "doc_id bigint, found array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, rules: list[tuple[str, str, int]] = BASE_RULES + EXTRA_RULES) -> DataFrame:
    """``doc_id`` and the text with every secret replaced by its kind in brackets (of overlapping
    spans the earlier one counts)."""
    found = _shard_scanner(rules)

    def cleaned(text: str, spans) -> str:
        made, at = [], 0
        for a, _, kind, b in spans:
            if a >= at:
                made += [text[at:a], f"[{kind}]"]
                at = b
        return "".join(made) + text[at:]

    def shard(columns):
        texts = [t or "" for t in columns["text"]]
        return {"doc_id": columns["doc_id"], "text": [cleaned(t, x) for t, x in zip(texts, found(texts))]}

    return map_batches(docs.select("doc_id", "text"), shard, "doc_id bigint, text string")
