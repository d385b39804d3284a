"""Line dedup by winnowing hashes of pieces of lines.

A text's lines are cut into pieces of at most ten words at places that the words themselves choose: behind a word whose
hash with the next word is the least within two words on either side. So a passage is cut alike, but for a few
words at its edges, whatever stands before it, also inside a line.

From each piece on, the pieces up to ``least`` words or just more are a window. Of the hashes of two neighbouring pieces in it, the least
(the last of equals) is its fingerprint; neighbouring windows mostly share one, so a third of the places is chosen. Equal
windows choose alike: a fingerprint that stands once in the corpus ends the search for its windows, and only fingerprints travel for that.
Where a fingerprint is met again, the match is extended to both sides: all windows that chose it are joined by a
hash of all their pieces, and one that occurs again after its first occurrence is deleted there. A longer
repetition is a chain of such windows. No occurrence is compared with one chosen partner: a
piece goes if it lies in any ``least`` words of whole pieces that stand earlier, in whatever document. A deleted piece
always has an equal piece earlier, so the first copy stays.

Which fingerprints are met again is told to the tasks by a bitmap of at most ``MOST_BITS`` bits, sized by their number; what it lets through
wrongly only costs rows, it hides nothing.

Order is by ``doc_id`` (null last), then hash of the text, then position. A repeated run in n places costs n rows. Text moves once, to
meet its deletions.

Defined results: null or blank texts have no pieces and stay as they are (null stays null); fully
repeated rows count as one row and give repeated results; rows with one ``doc_id`` and other text
are ordered by hash; an empty table gives no rows. Other columns pass through; ``n_chars``, if there, follows the text.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import map_batches, ships
from matchloom.llm.spaced_seeds import bitmap, maybe
from matchloom.session import materialize

ships(__name__)

LONGEST = 10  # words of a piece
CLEAR = 2  # words on either side among which a piece's last word has the least value
BLOCK = 1 << 18  # bytes whose words are hashed at once
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Draws the values of bytes. Any seed cuts as well; under this one the literal pieces that the tests name are still those.
SEED = 3
WINDOW = 4
LEAST = 25
LAST = (1 << 63) - 1
LEAST_BITS, MOST_BITS = 1 << 14, 1 << 26


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the words, and the bytes behind them."""
    edges = np.diff(np.r_[True, BLANK[raw], True].astype(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def word_values(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every word: of its bytes, whatever their order, which is enough to choose places by."""
    table = np.random.default_rng(SEED).integers(0, 1 << 63, 256, np.uint64)
    sums, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + BLOCK)))
        low = starts[i]
        total = np.r_[np.uint64(0), np.cumsum(table[raw[low:ends[j - 1]]])]
        sums[i:j] = total[ends[i:j] - low] - total[starts[i:j] - low]
        i = j
    return mixed(sums)


def last_words(values: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Whether a piece ends behind each word: at the end of a line, at a word that has (with the next one) the least value of all
    within CLEAR words of its line on either side, and ten words after the last such place."""
    n = len(values)
    if not n:
        return np.zeros(0, bool)
    ends = np.r_[line[1:] != line[:-1], True]
    if n > 2 * CLEAR + 1:
        own = mixed(values[:-1] * np.uint64(3) + values[1:])
        m = n - 1 - 2 * CLEAR  # places with CLEAR words before and CLEAR + 1 behind
        mid = slice(CLEAR, CLEAR + m)
        least = line[:m] == line[2 * CLEAR + 1:]
        for d in range(1, CLEAR + 1):
            least &= (own[mid] < own[CLEAR - d:CLEAR - d + m]) & (own[mid] <= own[CLEAR + d:CLEAR + d + m])
        ends[mid] |= least
    at = np.flatnonzero(ends)
    since = np.arange(n) - np.repeat(np.r_[0, at[:-1] + 1], np.diff(np.r_[-1, at]))
    return ends | (since % LONGEST == LONGEST - 1)


def pieces_in(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the pieces of all texts: starts and ends in code points of their text, numbers of words, and hashes
    (signed); and where each text's pieces start and the last one's end."""
    coded = [t.encode() for t in texts]
    data = b"\n".join(coded)
    raw = np.frombuffer(data, np.uint8)
    base = np.cumsum([0, *(len(t) + 1 for t in coded)])
    starts, ends = word_bounds(raw)
    line = np.searchsorted(np.flatnonzero(raw == 10), starts)
    at = np.flatnonzero(last_words(word_values(raw, starts, ends), line))
    first = np.r_[0, at[:-1] + 1][:len(at)]
    a, b = starts[first], ends[at]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[x:y]) for x, y in zip(a.tolist(), b.tolist())), np.uint64, len(at)).view(np.int64)
    bounds = np.searchsorted(a, base)
    points = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    origin = np.repeat(points[base[:-1]], np.diff(bounds))
    return points[a] - origin, points[b] - origin, at - first + 1, hashes, bounds


def cut(text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Spans of the pieces, and their hashes (signed)."""
    a, b, _, hashes, _ = pieces_in([text])
    return list(zip(a.tolist(), b.tolist())), hashes


def fingerprints(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the chosen grams: the smallest of each window, the last of equals. A sample of a text's
    pieces; ``deletions`` takes all."""
    n = len(hashes) - 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = hashes.view(np.uint64)
    with np.errstate(over="ignore"):
        grams = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
    if n <= window:
        at = np.array([n - 1 - int(grams[::-1].argmin())])
    else:
        views = np.lib.stride_tricks.sliding_window_view(grams, window)
        at = np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1))
    return at, grams[at].view(np.int64)


def order_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(LAST))


def grams(words: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of pieces that have ``least`` words or just more, one from each piece on: their first pieces, the pieces behind
    them, and their hashes (signed). None crosses a text's end."""
    n = len(hashes)
    total = np.r_[0, np.cumsum(words)]
    end = np.searchsorted(total, total[:-1] + least)
    at = np.flatnonzero(end <= np.repeat(bounds[1:], np.diff(bounds)))
    end = end[at]
    odd = 0x9E3779B97F4A7C15
    up, down = (np.cumprod(np.r_[np.uint64(1), np.full(n, x, np.uint64)]) for x in (odd, pow(odd, -1, 1 << 64)))
    sums = np.r_[np.uint64(0), np.cumsum(mixed(hashes.view(np.uint64)) * up[:-1])]
    return at, end, mixed((sums[end] - sums[at]) * down[at] + (end - at).astype(np.uint64)).view(np.int64)


def chosen(hashes: np.ndarray, at: np.ndarray, end: np.ndarray, two: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Of each window of pieces the place of its fingerprint, and the fingerprints of all places (signed): of two neighbouring pieces (or
    of one, where windows may have but one), the least in the window, the last of equals."""
    pairs = h = hashes.view(np.uint64)
    if two:
        pairs = mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    if not len(at):
        return at, pairs.view(np.int64)
    width = end - at - two
    level = np.frexp(width)[1] - 1  # windows are met by two spans of a power of two
    best, out = np.arange(len(pairs)), np.zeros(len(at), np.int64)
    for j in range(int(level.max()) + 1):
        if j:
            left, right = best[:-(1 << j - 1)], best[1 << j - 1:]
            best = np.where(pairs[right] <= pairs[left], right, left)
        here = np.flatnonzero(level == j)
        left, right = best[at[here]], best[at[here] + width[here] - (1 << j)]
        out[here] = np.where(pairs[right] <= pairs[left], right, left)
    return out, pairs.view(np.int64)


def windows_of(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``o``, ``h`` (naming a row), its windows from each piece on as long as there are words enough (hash, fingerprint, number of pieces, start and end in code
    points), and the ``prints`` of all places that a window chose."""
    def batch(c):
        starts, ends, words, hashes, bounds = pieces_in(c["text"])
        at, to, value = grams(words, hashes, bounds, least)
        mark, prints = chosen(hashes, at, to, least > LONGEST)
        places, where = np.searchsorted(at, bounds), np.unique(mark)
        apart = lambda x, where: [x[i:j] for i, j in zip(where[:-1], where[1:])]
        return {"o": c["o"], "h": c["h"], "runs": apart(value, places), "marks": apart(prints[mark], places), "sizes": apart(to - at, places),
                "starts": apart(starts[at], places), "ends": apart(ends[to - 1], places), "prints": apart(prints[where], np.searchsorted(where, bounds))}

    text = F.coalesce("text", F.lit(""))
    return map_batches(
        docs.select(order_of(F.col("doc_id")).alias("o"), F.xxhash64(text).alias("h"), text.alias("text")), batch,
        "o bigint, h bigint, runs array<bigint>, marks array<bigint>, sizes array<tinyint>, starts array<int>, ends array<int>, prints array<bigint>")


def _bits(hashes: DataFrame) -> int:
    """Size of a bitmap of these hashes: sixteen bits for each, within bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (16 * hashes.count()).bit_length()))


def deletions(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``o``, ``h``, ``spans`` (start, end in code points, apart and in order) and ``cut`` (pieces deleted)
    of every row that loses something."""
    table = materialize(windows_of(docs, least), "windows")
    again = materialize(table.select(F.explode("prints").alias("print")).groupBy("print").agg(F.count("*").alias("_n")).filter("_n > 1").select("print"), "prints")
    bits = _bits(again)
    zipped = F.arrays_zip(*[F.col(c).alias(n) for c, n in (("marks", "mark"), ("runs", "run"), ("sizes", "n"), ("starts", "start"), ("ends", "end"))])
    windows = table.select("o", "h", F.posexplode(zipped).alias("pos", "x")).filter(maybe(bitmap(again, bits), F.col("x.mark"), bits)).select(
        "o", "h", "pos", "x.run", "x.n", "x.start", "x.end")
    firsts = windows.groupBy("run").agg(F.min(F.struct("o", "h", "pos")).alias("f"), F.count("*").alias("_n")).filter("_n > 1").select("run", "f")
    later = windows.join(firsts, "run").filter("NOT (o = f.o AND h = f.h AND pos = f.pos)")
    found = later.groupBy("o", "h").agg(F.collect_set(F.struct("pos", "n", "start", "end")).alias("met"))

    def merged(c):
        out = {"o": c["o"], "h": c["h"], "spans": [], "cut": []}
        for met in c["met"]:
            joined: list[list[int]] = []  # first piece, piece behind, start, end
            for pos, n, start, end in sorted((w["pos"], w["n"], w["start"], w["end"]) for w in met):
                if joined and pos <= joined[-1][1]:
                    if pos + n > joined[-1][1]:
                        joined[-1][1], joined[-1][3] = pos + n, end
                else:
                    joined.append([pos, pos + n, start, end])
            out["spans"].append([{"start": start, "end": end} for _, _, start, end in joined])
            out["cut"].append(sum(b - a for a, b, _, _ in joined))
        return out

    return map_batches(found, merged, "o bigint, h bigint, spans array<struct<start:int,end:int>>, cut int")


def dedup(docs: DataFrame, least: int = LEAST, report: bool = False) -> DataFrame:
    """The documents without repeated runs; with ``report`` also ``removed`` (spans) and ``cut``."""
    gone = materialize(deletions(docs, least), "deletions").withColumnsRenamed({"o": "_lost_o", "h": "_lost_h", "spans": "_lost_spans", "cut": "_lost_cut"})
    text = F.coalesce(docs["text"], F.lit(""))
    named = F.xxhash64(order_of(docs["doc_id"]), F.xxhash64(text))
    rows = gone.select(F.xxhash64("_lost_o", "_lost_h"))
    bits = _bits(rows)
    loses = maybe(bitmap(rows, bits), named, bits)
    # Only texts that lose something move; the bitmap lets a few others come along.
    joined = docs.filter(loses).join(gone, (order_of(docs["doc_id"]) == F.col("_lost_o")) & (F.xxhash64(text) == F.col("_lost_h")), "left")
    cuts = F.col("_lost_spans")
    # What stands before each span, and after the last one.
    kept = F.transform(cuts, lambda s, i: F.substring(
        docs["text"], F.when(i == 0, F.lit(1)).otherwise(F.get(cuts, i - 1)["end"] + 1),
        s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(cuts, i - 1)["end"])))
    rest = F.substring(docs["text"], F.element_at(cuts, -1)["end"] + 1, F.length(docs["text"]))
    shorter = F.regexp_replace(F.concat(F.array_join(kept, ""), rest), r"\n(?:[\x20\x09\x0B-\x0D]*\n)+", "\n")
    new = F.when(cuts.isNull(), docs["text"]).otherwise(F.btrim(shorter, F.lit("\n")))
    made = joined.select(*[new.alias(c) if c == "text" else docs[c] for c in docs.columns], F.coalesce(cuts, F.array()).alias("_removed"),
                         F.coalesce(F.col("_lost_cut"), F.lit(0)).alias("_pieces"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        made = made.withColumn("n_chars", F.when(F.size("_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    nothing = F.array().cast(made.schema["_removed"].dataType)
    made = made.unionByName(docs.filter(~loses).withColumns({"_removed": nothing, "_pieces": F.lit(0)}))
    if report:
        return made.withColumnsRenamed({"_removed": "removed", "_pieces": "cut"})
    return made.drop("_removed", "_pieces")
