"""Benchmark decontamination with spaced seeds, in DataFrame operations only.

A mask names the positions of a window of words that count; the others are ignored, so a hit
survives substitutions there. Seeds of the benchmark and of the documents are joined by hash; each
hit gives a diagonal (offset of document against item), and the whole item is compared along it,
word by word: a document holds an item if ``least`` of the item's words agree.

Words are folded to lower case and rid of ASCII punctuation. The documents are scanned twice:
once for seeds, once for the words of documents with hits. Before the joins, rows are
filtered by a bitmap of ``BITS`` bits (a bound on what is broadcast, whatever the benchmark's size): it only
saves shuffling, the joins decide. Long texts are cut into overlapping segments, so windows of a
text are never all in memory at once.

Defined results: null or blank texts and items hold nothing; items with fewer words than a mask
are skipped, as chance would meet them; a fully repeated row is reported once, rows with one
``doc_id`` and other text each for themselves; a null ``doc_id`` stays null; repeated items are
reported under each of their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import BLANKS, LOWER, UPPER
from matchloom.session import materialize

MASKS = ("1101110011", "1110100111", "1011011101")
SPAN = len(MASKS[0])
SEGMENT = 256
BITS = 1 << 21
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def plain_words(text: Column) -> Column:
    """A text's words, folded and without punctuation."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:] + UPPER + PUNCTUATION, " " * 5 + LOWER)
    return F.array_remove(F.split(plain, " "), "")


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``h``, the hash of the text: together they name a row."""
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))


def _windows(df: DataFrame, keys: list[str], words: str, first: Column) -> DataFrame:
    """One row per window of SPAN words of a short array: the keys, ``pos`` (from ``first`` on) and the
    words' hashes c0, c1, ..."""
    ready = df.select(*keys, first.alias("first"), hashed(F.col(words)).alias("p"))
    many = F.greatest(F.size("p") - (SPAN - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("p", i + 1, many).alias(f"c{i}") for i in range(SPAN)])
    return ready.select(*keys, "first", F.posexplode_outer(zipped).alias("k", "w")).select(
        *keys, (F.col("first") + F.col("k")).alias("pos"), *[F.col("w")[f"c{i}"].alias(f"c{i}") for i in range(SPAN)])


def _anchors(items: DataFrame) -> DataFrame:
    """``a``: for every window and mask of the items, the pair of neighbours that count with the most letters (such
    a pair is rare as a rule). A document's window with the same seed has that pair too, so only
    windows around such pairs need be looked at."""
    starts = items.select("words", F.explode(F.sequence(F.lit(0), F.size("words") - SPAN)).alias("s"))
    word = lambda i: F.get("words", F.col("s") + i)
    longest = [
        F.array_max(F.array(*[F.struct((F.length(word(i)) + F.length(word(i + 1))).alias("n"), word(i).alias("v"), word(i + 1).alias("w"))
                              for i in range(SPAN - 1) if mask[i:i + 2] == "11"])) for mask in MASKS]
    return starts.select(F.explode(F.array(*longest)).alias("x")).select(F.xxhash64("x.v", "x.w").alias("a")).distinct()


def _seeds() -> list[Column]:
    return [F.xxhash64(F.lit(n), *[f"c{i}" for i, c in enumerate(mask) if c == "1"]) for n, mask in enumerate(MASKS)]


def bitmap(hashes: DataFrame, bits: int = BITS) -> Column:
    """A one-value subquery: the words (64 bits each) of a bitmap with two bits set per hash."""
    both = hashes.select(F.explode(F.array(*_places(F.col(hashes.columns[0]), bits))).alias("p"))
    one = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
    filled = both.groupBy(F.shiftright("p", 6).alias("i")).agg(F.bit_or(one).alias("b"))
    every = hashes.sparkSession.range(bits // 64).select(F.col("id").alias("i"))
    dense = every.join(filled, "i", "left").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("b", F.lit(0).cast("bigint")).alias("b")))).alias("x"))
    return dense.select(F.transform("x", lambda e: e["b"])).scalar()


def _places(h: Column, bits: int) -> list[Column]:
    return [h.bitwiseAND(bits - 1), F.shiftrightunsigned(h, 32).bitwiseAND(bits - 1)]


def maybe(bits_set: Column, h: Column, bits: int = BITS) -> Column:
    """False only if ``h`` is not among the hashes of the bitmap."""
    tests = []
    for p in _places(h, bits):
        word = F.get(bits_set, F.shiftright(p, 6).cast("int"))
        tests.append(F.getbit(word, p.bitwiseAND(63).cast("int")) == 1)
    return tests[0] & tests[1]


def overlaps(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """``doc_id``, ``h``, ``item_id``, ``start`` (word of the document where the item begins, negative if
    before its first), ``matched``, ``item_words`` and ``similarity`` of every document and item it holds."""
    items = materialize(
        benchmark.select("item_id", plain_words(F.col("text")).alias("words")).filter(F.size("words") >= SPAN)
        .withColumn("iw", hashed(F.col("words"))), "items")
    windows = _windows(items, ["item_id"], "words", F.lit(0))
    seeds = materialize(windows.select("item_id", F.col("pos").alias("ipos"), F.explode(F.array(*_seeds())).alias("seed")), "seeds")
    known, anchors = bitmap(seeds.select("seed")), bitmap(_anchors(items))
    # The outer form keeps the optimizer from splitting every text once more to test for emptiness.
    words = _identified(docs).select("doc_id", "h", plain_words(F.col("text")).alias("ws"))
    # Texts in parts of SEGMENT words, with what windows reach on either side: a row around a met
    # pair then carries a part, not its whole text.
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - 1, F.lit(0)), F.lit(SEGMENT))
    low = lambda s: F.greatest(F.lit(0), s - (SPAN - 1))
    parts = words.select("doc_id", "h", F.explode_outer(F.transform(starts, lambda s: F.struct(
        s.alias("s"), low(s).alias("low"), F.slice("ws", low(s) + 1, s - low(s) + SEGMENT + SPAN - 1).alias("ws")))).alias("_"))
    parts = parts.select("doc_id", "h", F.col("_.s").alias("s"), F.col("_.low").alias("low"), F.col("_.ws").alias("ws"))
    pairs = F.arrays_zip(F.col("ws").alias("v"), F.slice("ws", F.lit(2), F.greatest(F.size("ws") - 1, F.lit(0))).alias("w"))
    met = parts.select("doc_id", "h", "s", "low", "ws", F.posexplode_outer(pairs).alias("k", "x")).filter(
        (F.col("low") + F.col("k")).between(F.col("s"), F.col("s") + (SEGMENT - 1)) & maybe(anchors, F.xxhash64("x.v", "x.w")))
    first = F.greatest(F.lit(0), F.col("k") - (SPAN - 1))
    around = met.select("doc_id", "h", (F.col("low") + first).alias("at"), F.slice("ws", first + 1, F.col("k") + SPAN - first).alias("near"))
    rows = _windows(around, ["doc_id", "h"], "near", F.col("at"))
    found = rows.select("doc_id", "h", "pos", *[s.alias(f"s{n}") for n, s in enumerate(_seeds())])
    tests = [maybe(known, F.col(f"s{n}")) for n in range(len(MASKS))]
    hits = found.filter(tests[0] | tests[1] | tests[2]).select(
        "doc_id", "h", "pos", F.explode(F.array(*[f"s{n}" for n in range(len(MASKS))])).alias("seed"))
    diagonals = materialize(
        hits.join(seeds, "seed").select("doc_id", "h", "item_id", (F.col("pos") - F.col("ipos")).alias("start")).distinct(), "diagonals")
    row = lambda: F.xxhash64("doc_id", "h")
    again = _identified(docs).filter(maybe(bitmap(diagonals.select(row().alias("r"))), row()))
    again = again.join(diagonals.select("doc_id", "h").distinct().withColumnsRenamed({"doc_id": "_id", "h": "_h"}),
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left_semi")
    again = again.dropDuplicates(["doc_id", "h"]).select("doc_id", "h", hashed(plain_words(F.col("text"))).alias("wh"))
    pairs = diagonals.withColumnsRenamed({"doc_id": "_id", "h": "_h"}).join(items, "item_id").join(
        again, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")))
    skip, begin = F.greatest(-F.col("start"), F.lit(0)), F.greatest("start", F.lit(0))
    length = F.greatest(F.lit(0), F.least(F.size("iw") - skip, F.size("wh") - begin))
    same = F.zip_with(F.slice("wh", begin + 1, length), F.slice("iw", skip + 1, length), lambda a, b: a == b)
    scored = pairs.select("doc_id", "h", "item_id", "start", F.size("iw").alias("item_words"),
                          F.size(F.filter(same, lambda x: x)).alias("matched"))
    held = scored.filter(F.col("matched") >= least * F.col("item_words"))
    best = held.groupBy("doc_id", "h", "item_id").agg(
        F.max(F.struct("matched", (-F.col("start")).alias("s"))).alias("b"), F.first("item_words").alias("item_words"))
    return best.select("doc_id", "h", "item_id", (-F.col("b.s")).alias("start"), F.col("b.matched").alias("matched"),
                       "item_words", (F.col("b.matched") / F.col("item_words")).alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    held = overlaps(docs, benchmark, least).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    return docs.join(held, docs["doc_id"].eqNullSafe(held["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == held["_h"]), "left_anti")
