"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every whole text are computed in Arrow batches. Trees are grown on a bounded
sample of labelled rows (``max_rows``), with one histogram of gradients per leaf, feature and bin,
and flattened into parallel arrays (feature, threshold, left, right, value) that all rows walk
together, one numpy step per level.

Defined results: null text counts as empty and gets a score like any other; repeated rows give
repeated results; documents whose labels disagree are not learnt from; without labels of both
classes every score is the share of good labels (0.5 without any). The score does not depend on
``doc_id``, ``lang`` or ``source``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import LOWER, UPPER, WORD, map_batches, pieces, ships

ships(__name__)

SYMBOLS, STOPS = b"#*$%&|<>", b".!?,;:"
FEATURES = [
    "words", "chars", "word_length", "word_length_spread", "upper", "digits", "symbols", "stops", "marks", "distinct_words",
    "top_word", "top_pair", "repeats", "longest_repeat", "lines", "dup_lines", "line_words", "ended_lines",
    "bare_words", "short_words", "marked_words", "upper_words", "packed", "non_ascii",
]
#: A bound on the labelled rows that the driver sees: some 100 bytes each.
MAX_ROWS = 20_000


def statistics(text: str | None) -> list[float]:
    """The values named in FEATURES, over the whole text."""
    text = text or ""
    raw = text.encode()
    words = WORD.findall(text)
    n, size = max(1, len(words)), max(1, len(raw))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    same = [a == b for a, b in zip(words, words[1:])]
    run = longest = 0
    if any(same):
        for s in same:
            run = run + 1 if s else 0
            longest = max(longest, run)
    lines = [x for x in (y.strip() for y in text.split("\n")) if x]
    without = lambda chars: size - len(raw.translate(None, chars)) if raw else 0
    bare = sum(w.isalpha() for w in words)
    return [
        math.log1p(len(words)), math.log1p(len(text)), float(lengths.mean()), float(lengths.std()),
        without(UPPER.encode()) / size, without(b"0123456789") / size, without(SYMBOLS) / size, without(STOPS) / size,
        without(b"!?") / size, len(counts) / n, max(counts.values(), default=0) / n, max(pairs.values(), default=0) / n,
        sum(same) / n, math.log1p(longest), math.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        len(words) / max(1, len(lines)), sum(x[-1] in ".!?" for x in lines) / max(1, len(lines)),
        bare / n, sum(len(w) == 1 for w in words) / n, sum(not w[-1].isalnum() and w[-1] not in ".,!?" for w in words) / n,
        sum(map(str.isupper, words)) / n, len(zlib.compress(raw, 1)) / size, without(bytes(range(128, 256))) / size,
    ]


@dataclass
class Trees:
    """All trees in one set of arrays; a leaf points to itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(self.roots):
            node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total = total + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15,
         bins: int = 64, least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Boosted trees for the logistic loss, grown level by level from gradient histograms."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = math.log(share / (1 - share))
    empty = np.zeros(0, np.int64)
    if len(y) < 2 or y.min() == y.max():
        return Trees(base, empty, empty, np.zeros(0), empty, empty, np.zeros(0), 0)
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    usable = np.arange(bins)[None, :] < np.array([len(c) for c in cuts])[:, None]  # bin b goes left of cut b
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    raw = np.full(n, base)

    def add(v: float) -> int:
        feature.append(0), threshold.append(np.inf), left.append(len(value)), right.append(len(value)), value.append(v)
        return len(value) - 1

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        leaf = lambda rows: -rate * grad[rows].sum() / (hess[rows].sum() + ridge)
        roots.append(add(leaf(slice(None))))
        node = np.full(n, roots[-1])
        open_nodes = [roots[-1]]
        for _ in range(depth):
            slot = np.full(len(value), -1)
            slot[open_nodes] = np.arange(len(open_nodes))
            at = slot[node]
            rows = np.flatnonzero(at >= 0)
            if not len(rows):
                break
            cell = ((at[rows, None] * k + np.arange(k)) * bins + binned[rows]).ravel()
            shape = (len(open_nodes), k, bins)
            g = np.bincount(cell, np.repeat(grad[rows], k), math.prod(shape)).reshape(shape).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(hess[rows], k), math.prod(shape)).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g ** 2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g ** 2 / (all_h + ridge)
            gain[(h < least) | (all_h - h < least) | ~usable] = -1
            best = gain.reshape(len(open_nodes), -1).argmax(axis=1)
            grown = []
            for i, parent in enumerate(open_nodes):
                j, b = divmod(int(best[i]), bins)
                if gain[i, j, b] <= 1e-6:
                    continue
                mine = rows[at[rows] == i]
                goes_left = binned[mine, j] <= b
                feature[parent], threshold[parent] = j, cuts[j][b]
                for side, part in ((left, mine[goes_left]), (right, mine[~goes_left])):
                    side[parent] = add(leaf(part))
                    node[part] = side[parent]
                    grown.append(side[parent])
            open_nodes = grown
        raw = raw + np.array(value)[node]
    return Trees(base, np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right),
                 np.array(value), depth)


def labelled(docs: DataFrame, labels: DataFrame, column: str, learn_from, max_rows: int) -> DataFrame:
    """(doc_id, text, y) of at most about ``max_rows`` labelled documents, chosen by a hash of ``doc_id``.

    The chosen labels are bounded by ``max_rows``, so they are broadcast and the texts stay put."""
    known = labels.filter(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull()).filter(learn_from)
    known = known.groupBy("doc_id").agg(F.min(column).alias("y"), F.max(column).alias("_y")).filter("y = _y").drop("_y")
    share = max_rows / max(1, known.count())
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(0.97 * share * 1_000_000))
    chosen = F.broadcast(known.select("doc_id", F.col("y").cast("int").alias("y")).limit(max_rows))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")


def train(docs: DataFrame, labels: DataFrame, learn_from, max_rows: int = MAX_ROWS, **options) -> Trees:
    """Trees from the labelled documents that ``learn_from`` (a condition on ``doc_id``) admits."""
    rows = map_batches(
        labelled(docs, labels, "quality", learn_from, max_rows),
        lambda c: {"doc_id": c["doc_id"], "y": c["y"], "x": [statistics(t) for t in c["text"]]},
        "doc_id bigint, y int, x array<double>").groupBy("doc_id").agg(F.max("y").alias("y"), F.max("x").alias("x"))
    table = rows.orderBy("doc_id").toPandas()
    x = np.array(table["x"].tolist(), float).reshape(len(table), len(FEATURES))
    return grow(x, table["y"].to_numpy(float), **options)


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id`` and ``score`` of every document, one pass, no shuffle."""
    def batch(c):
        x = np.array([statistics(t) for t in c["text"]], float).reshape(len(c["text"]), len(FEATURES))
        return {"doc_id": c["doc_id"], "score": trees.scores(x)}

    return map_batches(docs.select("doc_id", "text"), batch, "doc_id bigint, score double")


def keep(docs: DataFrame, trees: Trees, least: float) -> DataFrame:
    """The documents, all columns, that score ``least`` or more."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in (part for whole in batches for part in pieces(whole)):
            x = np.array([statistics(t) for t in batch.column(at).to_pylist()], float)
            yield batch.filter(pa.array(trees.scores(x.reshape(batch.num_rows, len(FEATURES))) >= least))

    return docs.mapInArrow(run, docs.schema)
