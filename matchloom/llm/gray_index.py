"""SimHash near-dedup through a Gray-ordered hierarchical index.

Distinct fingerprints are laid out in 16 tables. Fingerprints that differ in at most three bits
agree in one of four 16-bit blocks, and within the other 48 bits in one of four 12-bit parts, so
they meet under the same 28-bit key of some table. Inside a key, fingerprints are sorted by Gray
rank; runs of eight neighbours form a node that factors out the bits they share (as a mask and a
pattern), nodes form nodes, up to one per key. The self-join walks pairs of nodes from the top:
bits fixed in both and different add up, and a pair of whole groups is dropped when they exceed
the limit, or when both groups are known to be linked already. Only a spanning forest leaves
a task, never all pairs; components are then joined by alternating stars.

Defined results: null or blank text has fingerprint zero and links like any other; exact copies
are one fingerprint, so a group of copies costs one entry; a null ``doc_id`` keeps its row and
counts last for the smallest id (a group of nulls only has a null component); repeated rows give
repeated results; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import BYTE_FOLD, map_batches, ships
from matchloom.llm.stars import components
from matchloom.session import materialize

ships(__name__)

LIMIT = 3
FAN = 8
CHUNK = 1 << 19  # node pairs expanded at once
BUFFER = 1 << 18  # rows joined at once, if no key has more


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _signed(ones: np.ndarray, size: int) -> int:
    return int(np.packbits(2 * ones > size, bitorder="little").view(np.int64)[0])


def fingerprint_of(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash of shingle hashes, repeats included; zero if there are none."""
    chunks = range(0, len(hashes), 1 << 16)
    return _signed(sum((_ones(hashes[a:a + (1 << 16)]) for a in chunks), np.zeros(64, np.int64)), len(hashes))


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit SimHash over word shingles, repeats included; a bit is set if it is in over half of them."""
    words = (text or "").encode().translate(BYTE_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = max(1, len(words) - width + 1)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends)]
    last = ends[len(words) - size:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for a in range(0, size, 1 << 16):
        b = min(size, a + (1 << 16))
        h = np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts[a:b], last[a:b])), np.uint64, b - a)
        ones += _ones(h)
    return _signed(ones, size)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` and ``same`` (a hash of the text) of every row."""
    return map_batches(
        docs.select("doc_id", "text", text_hash(docs["text"]).alias("same")),
        lambda c: {"doc_id": c["doc_id"], "fp": [fingerprint(t, width) for t in c["text"]], "same": c["same"]},
        "doc_id bigint, fp bigint, same bigint")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def gray_rank(fp: Column) -> Column:
    """Position in Gray order, as a signed number that sorts like the unsigned one."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def table_keys(fp: Column) -> Column:
    """The 16 keys of a fingerprint: table, block value, part value."""
    blocks = [F.shiftrightunsigned(fp, 16 * b).bitwiseAND(0xFFFF) for b in range(4)]
    keys = []
    for b in range(4):
        rest = [blocks[x] for x in range(4) if x != b]
        wide = rest[0].bitwiseOR(F.shiftleft(rest[1], 16)).bitwiseOR(F.shiftleft(rest[2], 32))
        for p in range(4):
            part = F.shiftrightunsigned(wide, 12 * p).bitwiseAND(0xFFF)
            keys.append(F.lit((4 * b + p) << 28).bitwiseOR(F.shiftleft(blocks[b], 12)).bitwiseOR(part))
    return F.array(*keys)


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the smallest index of the group) after joining i with j."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def linked(keys: np.ndarray, fps: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """For rows sorted by key and Gray rank: the index of the first row of each row's group, groups
    being rows of one key chained by at most ``limit`` differing bits."""
    n = len(keys)
    label = np.arange(n)
    if n < 2:
        return label
    fresh = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[fresh, n])
    # Levels from the leaves up: shared ones, shared zeros, first leaf, end leaf, first child, key.
    ones, zeros = fps, ~fps
    levels = [(ones, zeros, np.arange(n), np.arange(1, n + 1), None, None)]
    first, count = fresh, size
    while (count > 1).any():
        groups = -(-count // FAN)
        owner = np.repeat(np.arange(len(count)), groups)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(groups) - groups, groups)
        child = first[owner] + within * FAN
        end = np.minimum(child + FAN, (first + count)[owner])
        ones, zeros = np.bitwise_and.reduceat(ones, child), np.bitwise_and.reduceat(zeros, child)
        low, high = levels[-1][2][child], levels[-1][3][end - 1]
        levels.append((ones, zeros, low, high, child, end))
        first, count = np.cumsum(groups) - groups, groups
    roots = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, roots, roots)]
    while stack:
        level, u, v = stack.pop()
        if len(u) > CHUNK:
            stack.append((level, u[CHUNK:], v[CHUNK:]))
            u, v = u[:CHUNK], v[:CHUNK]
        ones, zeros, low, high, child, end = levels[level]
        near = np.bitwise_count((ones[u] & zeros[v]) | (zeros[u] & ones[v])) <= limit
        if level and len(u) > 1024:
            # A pair of groups that already form one component has nothing to add.
            bounds, padded = np.c_[low, high].ravel(), np.r_[label, 0]
            least, most = np.minimum.reduceat(padded, bounds)[::2], np.maximum.reduceat(padded, bounds)[::2]
            near &= ~((least[u] == most[u]) & (least[v] == most[v]) & (least[u] == least[v]))
        u, v = u[near], v[near]
        if not level:
            label = _merge(label, u, v)
            continue
        # Children of u with children of v; within one node each pair once.
        cu, cv = end[u] - child[u], end[v] - child[v]
        rows = np.repeat(np.arange(len(u)), cu * cv)
        k = np.arange(len(rows)) - np.repeat(np.cumsum(cu * cv) - cu * cv, cu * cv)
        a, b = child[u][rows] + k // cv[rows], child[v][rows] + k % cv[rows]
        once = (a < b) | ((a == b) & (level > 1))
        stack.append((level - 1, a[once], b[once]))
    return label


def forest(rows: DataFrame) -> DataFrame:
    """Edges (a, b) of a spanning forest of the links within each key of ``rows`` (key, fp)."""
    def run(batches):
        held_k, held_f, waiting = [], [], 0

        def flush(last: bool):
            nonlocal held_k, held_f, waiting
            k, f = np.concatenate(held_k), np.concatenate(held_f)
            cut = len(k) if last else int(np.searchsorted(k, k[-1]))
            label = linked(k[:cut], f[:cut].view(np.uint64))
            moved = np.flatnonzero(label != np.arange(cut))
            held_k, held_f = [k[cut:]], [f[cut:]]
            waiting = len(k) - cut
            return pa.RecordBatch.from_arrays([pa.array(f[moved]), pa.array(f[label[moved]])], names=["a", "b"])

        limit = BUFFER
        for batch in batches:
            if batch.num_rows:
                held_k.append(batch.column(0).to_numpy())
                held_f.append(batch.column(1).to_numpy())
                waiting += batch.num_rows
                if waiting >= limit:
                    yield flush(False)
                    limit = max(BUFFER, 2 * waiting)
        if waiting:
            yield flush(True)

    return rows.mapInArrow(run, "a bigint, b bigint")


def linked_groups(distinct: DataFrame) -> DataFrame:
    """``fp`` and ``root`` (one fingerprint per group) of every one of the distinct fingerprints that has a link."""
    rows = distinct.select(F.explode(table_keys(F.col("fp"))).alias("key"), "fp")
    sorted_rows = rows.repartition("key").sortWithinPartitions("key", gray_rank(F.col("fp")))
    edges = forest(sorted_rows).distinct()
    return components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("fp"), "root")


def groups(prints: DataFrame) -> DataFrame:
    """``fp``, ``root`` (one fingerprint per group) and ``component_id`` of every distinct fingerprint."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    known = distinct.join(linked_groups(distinct), "fp", "left")
    known = known.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = known.filter(F.col("root") != F.col("fp")).groupBy("root").agg(F.min("least").alias("_least"))
    # Roots take part through their own row; members look their root up.
    own = distinct.select(F.col("fp").alias("root"), F.col("least").alias("_own"))
    best = smallest.join(own, "root").select("root", F.least("_least", "_own").alias("component_id"))
    return known.join(best, "root", "left").select(
        "fp", "root", F.coalesce("component_id", "least").alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``fp``, ``same``, ``root`` and ``component_id`` of every row."""
    prints = materialize(fingerprints(docs, width), "prints")
    return prints.join(groups(prints), "fp").select("doc_id", "fp", "same", "root", "component_id")


def one_of_each(docs: DataFrame, width: int = 3) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest ``doc_id`` stays
    (ties: the smallest hash of the text; of fully repeated rows one)."""
    found = near_duplicates(docs, width)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "same")
    stays = found.groupBy("root").agg(F.min(order).alias("_o")).select(F.col("_o.doc_id").alias("_kept_id"), F.col("_o.same").alias("_kept_same"))
    stays = stays.distinct()
    kept = docs.join(stays, docs["doc_id"].eqNullSafe(stays["_kept_id"]) & (text_hash(docs["text"]) == stays["_kept_same"]))
    # Rows of one id and text are together already; one of them stays.
    return kept.dropDuplicates(["_kept_id", "_kept_same"]).select(*[docs[c] for c in docs.columns])
