"""Near copies by exact Jaccard similarity of word shingles.

Two texts are near copies if the sets of their ``width``-word shingles (A-Z folded; a shorter text is one
shingle, a text without words the empty one) have a Jaccard similarity of ``LEAST`` or more. SimHash cannot
find all of them by few differing bits: texts at 0.8 differ in about ten of 64. So pairs to compare come from two
places. The Gray tables of ``gray_index`` link the texts' SimHashes (same shingles, repeats included) at three bits or fewer,
and what they link is one key. For the rest, minima of the sets are taken under BANDS * ROWS hash functions, of which ROWS
make a key: texts at 0.8 miss each other's keys with a chance of (1 - 0.8^5)^32, three in a million, nearer ones more
rarely. Every pair is then verified on the sets themselves, so nothing is linked that is not at ``LEAST``.

Exact copies are one text. Texts of one key are first compared with the smallest of them, which joins
a group of near copies at one pair a text; then every pair of one key that is still in two components, and of
sizes that can reach ``LEAST`` at all, is compared too. No key, group or list of partners is cut short.

Defined results: null and blank texts are copies of each other; a null ``doc_id`` counts last; of fully
repeated rows one stays; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import BYTE_FOLD, map_batches, ships
from matchloom.llm.gray_index import fingerprint_of, linked_groups, text_hash
from matchloom.llm.stars import components
from matchloom.session import materialize

ships(__name__)

LEAST = (4, 5)  # 0.8 as a fraction, so that the bound itself is met exactly
BANDS, ROWS = 32, 5
BLOCK = 1 << 8  # shingles put through all hash functions at once


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Hashes of a text's shingles, repeats included; none for a text without words."""
    words = (text or "").encode().translate(BYTE_FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    size = max(1, len(words) - width + 1)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, ends[len(words) - size:])), np.uint64, size)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The set of a text's shingles, sorted: that of a text without words holds a zero."""
    return np.unique(hashes) if len(hashes) else np.zeros(1, np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return distinct(shingle_hashes(text, width))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS keys of a set of hashes (signed)."""
    draw = np.random.default_rng(5).integers(0, 1 << 32, (2, BANDS * ROWS), np.uint32)
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    mixed = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for a in range(0, len(mixed), BLOCK):
        v = (mixed[a:a + BLOCK, None] ^ draw[0]) * (draw[1] | np.uint32(1))
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        low = np.minimum(low, v.min(axis=0))
    rows = low.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), b) for b, r in enumerate(rows)], np.uint64).view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``same`` (hash of the text), ``n`` (shingles), ``fp`` (SimHash) and ``keys`` of every distinct text."""
    def batch(c):
        hashes = [shingle_hashes(t, width) for t in c["text"]]
        sets = [distinct(h) for h in hashes]
        return {"same": c["same"], "n": [len(s) for s in sets], "fp": [fingerprint_of(h) for h in hashes],
                "keys": [band_keys(s) for s in sets]}

    texts = docs.select(text_hash(docs["text"]).alias("same"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return map_batches(texts, batch, "same bigint, n int, fp bigint, keys array<bigint>").dropDuplicates(["same"])


def gray_keys(table: DataFrame) -> DataFrame:
    """``same``, ``n`` and ``key``: the group of its SimHash in the Gray tables, for every text of ``table``."""
    prints = materialize(table.select("fp").distinct(), "prints")
    found = table.join(linked_groups(prints), "fp", "left")
    return found.select("same", "n", F.xxhash64(F.lit("gray"), F.coalesce("root", "fp")).alias("key"))


def verified(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Those of ``pairs`` (u, v: text hashes) whose shingle sets have LEAST in common."""
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("same")).distinct()
    texts = docs.select(text_hash(docs["text"]).alias("same"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    sets = materialize(map_batches(
        texts.join(wanted, "same", "left_semi"),
        lambda c: {"same": c["same"], "set": [shingles(t, width).view(np.int64) for t in c["text"]]},
        "same bigint, set array<bigint>").dropDuplicates(["same"]), "sets")
    both = pairs.join(sets.select(F.col("same").alias("u"), F.col("set").alias("left")), "u").join(
        sets.select(F.col("same").alias("v"), F.col("set").alias("right")), "v").select("u", "v", "left", "right")

    def compare(c):
        out = {"u": [], "v": []}
        for u, v, left, right in zip(c["u"], c["v"], c["left"], c["right"]):
            common = len(np.intersect1d(left, right, assume_unique=True))
            if common * LEAST[1] >= (len(left) + len(right) - common) * LEAST[0]:
                out["u"].append(u), out["v"].append(v)
        return out

    return map_batches(both, compare, "u bigint, v bigint")


def roots(docs: DataFrame, width: int) -> DataFrame:
    """``same`` and ``root`` (one text per component) of every text that has a near copy."""
    table = materialize(sketches(docs, width), "sketches")
    keyed = gray_keys(table).unionByName(table.select("same", "n", F.explode("keys").alias("key")))
    shared = keyed.groupBy("key").agg(F.min("same").alias("u"), F.count("*").alias("_k")).filter("_k > 1").select("key", "u")
    keyed = materialize(keyed.join(shared, "key"), "keyed")
    first = materialize(keyed.filter("same != u").select("u", F.col("same").alias("v")).distinct(), "pairs")
    links = materialize(verified(docs, first, width), "links")
    known = components(links)
    # What one key holds of several components.
    placed = keyed.join(known.select(F.col("node").alias("same"), "root"), "same", "left").select(
        "key", "same", "n", F.coalesce("root", "same").alias("root"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a != _b").select("key")
    left = materialize(placed.join(open_keys, "key", "left_semi"), "open")
    other = left.select("key", F.col("same").alias("v"), F.col("n").alias("m"), F.col("root").alias("other"))
    rest = left.withColumnRenamed("same", "u").join(other, "key").filter(
        (F.col("u") < F.col("v")) & (F.col("root") != F.col("other"))
        & (F.least("n", "m") * LEAST[1] >= F.greatest("n", "m") * LEAST[0])).select("u", "v").distinct()
    rest = materialize(rest.join(first, ["u", "v"], "left_anti"), "rest")
    more = materialize(links.unionByName(verified(docs, rest, width)), "links")
    return components(more).select(F.col("node").alias("same"), "root")


def one_of_each(docs: DataFrame, width: int) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest ``doc_id`` stays
    (ties: the smallest hash of the text; of fully repeated rows one)."""
    rows = docs.select("doc_id", text_hash(docs["text"]).alias("same"))
    rows = rows.join(roots(docs, width), "same", "left").select("doc_id", "same", F.coalesce("root", "same").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "same")
    stays = rows.groupBy("root").agg(F.min(order).alias("_o")).select(F.col("_o.doc_id").alias("_kept_id"), F.col("_o.same").alias("_kept_same"))
    kept = docs.join(stays, docs["doc_id"].eqNullSafe(stays["_kept_id"]) & (text_hash(docs["text"]) == stays["_kept_same"]))
    return kept.dropDuplicates(["_kept_id", "_kept_same"]).select(*[docs[c] for c in docs.columns])
