"""Source divergence audit: word-start pointers sorted per shard, counts joined over shards, divergences in exact arithmetic.

A shard is a slice of an Arrow batch of a few megabytes. Pointers to the starts of its terms are built over the Arrow buffer of the
texts; the buffer itself is not copied word by word. The pointers are sorted as multikey quicksort does: slices of one (lang, source) first, then
by the next eight bytes of the terms, only inside runs that are equal so far and only while a term there has bytes left; all
runs of a depth are sorted by one call. A run of equal terms gives the term's occurrences and, as pointers of a run stand in the order of the
documents, its documents. Counts of shards are summed by Spark.

With p = 1 + floor(10^9 (count + 1) / (N + V)) for a group and f = floor((p - q)^2 / q), the sum of f over all kept terms of a language
for a pair of sources is, with p0 the value of a count of 0,
sum over the first's terms of f(p, q0), plus the same over the second's of f(p0, q), plus f(p0, q0) for the others, plus a correction for
the terms that both hold. The first two come from how many terms of a source have each count; only the correction looks at terms, and adds
up pairs of a term's sources in numpy inside a task, so that pairs never become rows.

Defined results: null text, lang and source are empty strings; every (lang, source) that occurs is a group, also without terms; with no kept
terms all pair values are 0; a lone source has no pairs; rows are documents, so fully repeated rows count as often as they stand;
very long texts are read whole (a text is never split over shards); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.base import pieces, ships
from matchloom.session import materialize

ships(__name__)

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
PAIRS = 1 << 20  # of sources of terms, worked on at once
#: What a byte of a term becomes; 0 for bytes that no term holds. Bytes of 128 and more are all of a non-ASCII letter.
TERM_BYTE = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 0 for b in range(256)], np.uint8)


def pointers(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the terms of folded bytes, and the number of the text each stands in."""
    inside = raw != 0
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True  # terms do not run from a text into the next
    before = np.r_[False, inside[:-1]]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.r_[inside[1:], False]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, "right") - 1


def eight_bytes(raw: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next bytes of each term as one number that sorts as they do; 0 behind its end. ``raw`` has eight bytes to spare."""
    words = np.ndarray(len(raw) - 7, ">u8", raw, strides=(1,))
    key = words[np.where(left > 0, at, 0)].astype(np.uint64)
    short = np.uint64(8) * np.uint64(8) - np.uint64(8) * np.clip(left, 0, 8).astype(np.uint64)
    return np.where(left > 0, key >> np.minimum(short, np.uint64(63)) << np.minimum(short, np.uint64(63)), np.uint64(0))


def sorted_runs(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers' order by (group, term, place), and where each run of equal ones starts in it."""
    n = len(starts)
    order = np.argsort(group, kind="stable")
    new = np.r_[True, np.diff(group[order]) != 0][:n]
    active, depth = np.arange(n), 0  # places of the order whose runs are not told apart yet
    while len(active):
        here = order[active]
        key = eight_bytes(raw, starts[here] + depth, sizes[here] - depth)
        run = np.cumsum(new[active])
        by = np.lexsort((key, run))  # stable; runs stay where they are
        order[active] = here[by]
        key = key[by]
        new[active[1:]] |= key[1:] != key[:-1]
        depth += 8
        run = np.cumsum(new[active])
        longest = np.zeros(run[-1] + 1, np.int64)
        np.maximum.at(longest, run, sizes[order[active]] - depth)
        many = np.bincount(run) > 1
        active = active[many[run] & (longest[run] > 0)]
    return order, np.flatnonzero(new)


def gathered(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings of such places, as one Arrow array."""
    ends = np.cumsum(sizes)
    data = raw[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
    offsets = np.r_[0, ends].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """lang, source, term, occurrences and documents of a shard."""
    text, lang, source = batch.column("text").cast(pa.large_string()), batch.column("lang"), batch.column("source")
    _, where, data = text.buffers()
    offsets = np.frombuffer(where, np.int64)[text.offset:text.offset + len(text) + 1]
    raw = TERM_BYTE[np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]]
    raw, offsets = np.r_[raw, np.zeros(8, np.uint8)], offsets - offsets[0]
    starts, sizes, doc = pointers(raw, offsets)
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    code = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    order, runs = sorted_runs(raw, starts, sizes, code[doc])
    total = np.diff(np.r_[runs, len(order)])
    docs = doc[order]
    seen = np.r_[True, docs[1:] != docs[:-1]][:len(docs)]
    seen[runs] = True
    one = order[runs]
    back = pa.array(doc[one])
    return pa.RecordBatch.from_arrays(
        [lang.take(back), source.take(back), gathered(raw, starts[one], sizes[one]), pa.array(total.astype(np.int64)),
         pa.array(np.add.reduceat(seen.astype(np.int64), runs) if len(runs) else np.zeros(0, np.int64))], names=["lang", "source", "term", "n", "docs"])


def shard_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            yield counted(part)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (N + V)), exact; null without kept terms."""
    wide = (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)") + 1
    top = (wide * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)")
    return F.when(kept > 0, F.call_function("div", top, (total + kept).cast("decimal(38,0)")).cast("bigint") + 1)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every two sources of a batch the sum, over the terms that both hold, of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)."""
    for batch in batches:
        for part in pieces(batch):
            held = part.column("held")
            flat, sizes = held.flatten(), np.diff(held.offsets.to_numpy())
            name, p, p0 = flat.field("source").dictionary_encode(), flat.field("p").to_numpy(), flat.field("p0").to_numpy()
            names, code = name.dictionary, name.indices.to_numpy().astype(np.int64)
            langs = part.column("lang").dictionary_encode()
            ends = np.cumsum(sizes)
            # Each element meets all elements of its row: a block of elements at a time.
            width, low = np.repeat(sizes, sizes), np.repeat(ends - sizes, sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            lang = langs.indices.to_numpy().astype(np.int64)[row]
            met = np.cumsum(width)
            i, sums = 0, {}
            while i < len(width):
                j = max(i + 1, int(np.searchsorted(met, met[i] - width[i] + PAIRS, "right")))
                w = width[i:j]
                x = np.repeat(np.arange(i, j), w)
                y = np.arange(len(x)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(low[i:j], w)
                apart = x != y
                x, y = x[apart], y[apart]
                value = far(p[x], p[y]) - far(p[x], p0[y]) - far(p0[x], p[y]) + far(p0[x], p0[y])
                key = (lang[x] * len(names) + code[x]) * len(names) + code[y]
                order = np.argsort(key, kind="stable")
                key = key[order]
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
                for k, v in zip(key[first].tolist(), np.add.reduceat(value[order], first).tolist() if len(first) else []):
                    sums[k] = sums.get(k, 0) + v
                i = j
            key = np.array(list(sums), np.int64)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(key // len(names) ** 2 if len(names) else key)), names.take(pa.array(key // max(len(names), 1) % max(len(names), 1))),
                 names.take(pa.array(key % max(len(names), 1))), pa.array(list(sums.values()), pa.int64())], names=["lang", "source", "item", "value"])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shards = docs.mapInArrow(shard_counts, "lang string, source string, term string, n bigint, docs bigint")
    counts = shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held"))
    kept = materialize(terms.filter(F.col("docs") >= least_docs).drop("docs"), "kept_terms")
    held = kept.select("lang", "term", "in_lang", F.inline("held"))

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = materialize(
        docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", zero("total"), zero("own"), zero("v"), zero("lang_total")).withColumn("p0", share(F.lit(0), F.col("total"), F.col("v"))), "groups")

    shares = materialize(held.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "p0", share("n", F.col("total"), F.col("v")).alias("p"), share("in_lang", F.col("lang_total"), F.col("v")).alias("q")), "shares")
    by_term = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))

    this, other = groups.alias("g"), groups.alias("h")
    base = this.join(other, (F.col("g.lang") == F.col("h.lang")) & (F.col("g.source") != F.col("h.source"))).select(
        "g.lang", "g.source", F.col("h.source").alias("item"),
        F.when(F.col("g.v") > 0, (F.col("g.v") - F.col("g.own") - F.col("h.own")) * distance(F.col("g.p0"), F.col("h.p0"))).otherwise(0).alias("value"))
    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("many"), F.first("p0").alias("p0"))
    met = levels.alias("g").join(groups.select("lang", "source", "p0").alias("h"), (F.col("g.lang") == F.col("h.lang")) & (F.col("g.source") != F.col("h.source")))
    alone = met.select("g.lang", F.inline(F.array(
        F.struct(F.col("g.source").alias("source"), F.col("h.source").alias("item"), (F.col("many") * distance(F.col("p"), F.col("h.p0"))).alias("value")),
        F.struct(F.col("h.source").alias("source"), F.col("g.source").alias("item"), (F.col("many") * distance(F.col("h.p0"), F.col("p"))).alias("value")))))
    both = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("held")).filter(F.size("held") > 1).select(
        "lang", "held").mapInArrow(corrections, "lang string, source string, item string, value bigint")
    pairs = base.unionByName(alone).unionByName(both).groupBy("lang", "source", "item").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = by_term.withColumn("rank", rank).filter(F.col("rank") <= top)  # the limit is also applied before the shuffle
    return pairs.withColumn("rank", rank).unionByName(ranked)
