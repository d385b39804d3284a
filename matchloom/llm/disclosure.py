"""Sanitisation by information: personal data, and the words around it that give it away.

Personal data of fixed forms (mail and network addresses, card and phone numbers) is found by pattern. Each distinct value is
a protected entity. The words near an entity are its context; over the whole corpus,

    disclosure(word; entity) = log(P(word | entity) * N / n(word)) / log(N / n(entity))

is the share of the entity's information that the word reveals (1: the word occurs with the
entity only). n(word) and N count documents; n(word, entity) and n(entity) count distinct contexts, so
copies of one passage are one piece of evidence. P(word | entity) is shrunk to what the word is near any entity of the kind:
(n(word, entity) + prior * P(word | kind)) / (n(entity) + prior). So an entity of any number of contexts is looked at, and one met once
needs words that are next to unknown elsewhere. Words with a disclosure of ``threshold`` or more become spans: generalised to their class (number,
name, word) if the class itself discloses less, else removed.

The scan leaves one narrow row per document and the contexts; word frequencies are then counted for the words seen in
repeated contexts only, told by a bitmap of fixed size and settled by the join.

Defined results: null text counts as empty; repeated rows count each as documents and give
repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import FOLD, WORD, map_batches, pieces, ships
from matchloom.session import materialize

ships(__name__)

KINDS = ["email", "ip", "card", "phone"]
REACH = 6  # words on either side
PRIOR = 2.0  # contexts that the kind of an entity counts for
THRESHOLD = 0.8
PARTS = 16
BITS = 1 << 21
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str):
    """Leftmost non-overlapping addresses. A match starts where the run of local characters before
    an @ starts, or where the last match ended, so each @ is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def term(word: str) -> str:
    return word.translate(FOLD).strip(EDGES)


def contexts(text: str, spans: list[tuple[str, int, int]], reach: int = REACH):
    """(entity, context hash, [(term, start, end)]) of every span: words near it that are in no span."""
    if not spans:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    starts = [a for a, _ in words]
    taken: list[list[int]] = []  # what the spans cover, apart and in order
    for a, b in sorted((a, b) for _, a, b in spans):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    begins = [a for a, _ in taken]

    def free(x: int, y: int) -> bool:
        i = bisect_left(begins, y) - 1
        return i < 0 or taken[i][1] <= x

    out = []
    for kind, a, b in spans:
        first, last = max(0, bisect_right(starts, a) - 1), bisect_left(starts, b)
        near = words[max(0, first - reach):first] + words[last:last + reach]
        terms = [(t, x, y) for x, y in near if free(x, y) and (t := term(text[x:y]))]
        value = text[a:b].translate(FOLD) if kind in ("email", "ip") else _digits(text[a:b])
        seen = xxhash.xxh64_intdigest(" ".join(t for t, _, _ in terms), 42) - (1 << 63)
        out.append((f"{kind}:{value}", seen, terms))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``base`` (kind, start, end) and ``near`` (entity, context, terms) of every row."""
    def batch(c):
        out = {"key": c["key"], "doc_id": c["doc_id"], "base": [], "near": []}
        for t in c["text"]:
            spans = base_spans(t or "")
            out["base"].append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            out["near"].append([{"entity": e, "context": h, "terms": [{"term": w, "start": a, "end": b} for w, a, b in ts]}
                                for e, h, ts in contexts(t or "", spans)])
        return out

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    return map_batches(
        keyed, batch, "key bigint, doc_id bigint, base array<struct<kind:string,start:bigint,end:bigint>>, near array<struct<"
        "entity:string,context:bigint,terms:array<struct<term:string,start:bigint,end:bigint>>>>")


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term`` and ``n``, the number of documents with it, of the given distinct terms."""
    spark = docs.sparkSession
    places = terms.select((F.pmod(F.xxhash64("term"), F.lit(BITS))).alias("p")).groupBy(
        F.expr("CAST(p DIV 8 AS INT)").alias("i")).agg(F.bit_or(F.expr("shiftleft(1, CAST(p % 8 AS INT))")).alias("b"))
    bits = bytearray(BITS // 8)
    for i, b in places.collect():  # at most BITS / 8 rows
        bits[i] = b
    shared = spark.sparkContext.broadcast(bytes(bits))

    def run(batches):
        bits, seen, known = shared.value, Counter(), {}
        for batch in (part for whole in batches for part in pieces(whole)):
            for t in batch.column(0).to_pylist():
                for w in set(WORD.findall(t or "")):
                    k = known.get(w)
                    if k is None:
                        s = term(w)
                        p = (h - (1 << 64) if (h := xxhash.xxh64_intdigest(s, 42)) >> 63 else h) % BITS
                        if len(known) > 300_000:
                            known.clear()
                        k = known[w] = s if s and bits[p >> 3] >> (p & 7) & 1 else ""
                    if k:
                        seen[k] += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    counted = docs.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return counted.join(terms, "term")


def kind_of(word):
    """The class a term is generalised to."""
    return F.when(word.rlike("^[0-9.,:/-]+$"), "number").otherwise("word")


def telling(docs: DataFrame, found: DataFrame, prior: float = PRIOR, threshold: float = THRESHOLD) -> DataFrame:
    """``entity``, ``term`` and ``action`` (generalise or remove) of every word that gives an entity away."""
    each = found.select(F.explode("near").alias("x")).select("x.entity", "x.context", "x.terms")
    once = each.groupBy("entity", "context").agg(F.first("terms").alias("terms"))
    kind = F.substring_index("entity", ":", 1)
    entities = once.groupBy("entity").agg(F.count("*").alias("n_e"))
    kinds = once.groupBy(kind.alias("_kind")).agg(F.count("*").alias("_kind_n"))  # one row a kind
    pairs = once.select("entity", F.explode(F.array_distinct(F.transform("terms", lambda t: t["term"]))).alias("term"))
    pairs = materialize(pairs.groupBy("entity", "term").agg(F.count("*").alias("n_te")).join(entities, "entity").withColumn("_kind", kind), "pairs")
    near_kind = pairs.groupBy("_kind", "term").agg(F.sum("n_te").alias("_near")).join(F.broadcast(kinds), "_kind")
    pairs = pairs.join(near_kind.withColumn("p_kind", F.col("_near") / F.col("_kind_n")).select("_kind", "term", "p_kind"), ["_kind", "term"])
    n = float(max(2, docs.count()))
    given = (F.col("n_te") + prior * F.col("p_kind")) / (F.col("n_e") + prior)
    share = lambda count: F.log(F.lit(n) * given / F.col(count)) / F.greatest(F.log(F.lit(n) / F.col("n_e")), F.lit(1e-9))
    # A word stands in no fewer documents than it stands near a value in: too many of these rule it out before it is counted.
    near = F.array_distinct(F.flatten(F.transform("near", lambda x: F.transform(x["terms"], lambda t: t["term"]))))
    least = found.select(F.explode(near).alias("term")).groupBy("term").agg(F.count("*").alias("n_near"))
    pairs = materialize(pairs.join(least, "term").filter(share("n_near") >= threshold), "candidates")
    # So does its count in any part of the documents: words of a sixteenth that are too frequent there already need no count
    # over all. What is left is rare, and counted over all documents.
    part = docs.filter(F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(PARTS)) == 0)
    part = part.coalesce(max(1, docs.rdd.getNumPartitions() // PARTS))
    common = document_counts(part, pairs.select("term").distinct()).withColumnRenamed("n", "n_part")
    pairs = materialize(pairs.join(common, "term", "left").filter(F.col("n_part").isNull() | (share("n_part") >= threshold)).drop("n_part"), "candidates")
    terms = document_counts(docs, pairs.select("term").distinct())
    strong = pairs.join(terms, "term").filter(share("n") >= threshold)
    # The class of the word, over all contexts of the entity against all contexts.
    classes = once.select("entity", F.explode(F.array_distinct(F.transform("terms", lambda t: kind_of(t["term"])))).alias("kind"))
    by_class = classes.groupBy("kind").agg(F.count("*").alias("n_k"))
    with_class = strong.drop("_kind").withColumn("kind", kind_of(F.col("term"))).join(
        classes.groupBy("entity", "kind").agg(F.count("*").alias("n_ke")), ["entity", "kind"]).join(F.broadcast(by_class), "kind")
    contexts_n = F.lit(float(max(2, once.count())))
    general = F.log(contexts_n * F.col("n_ke") / (F.col("n_k") * F.col("n_e"))) / F.greatest(F.log(contexts_n / F.col("n_e")), F.lit(1e-9))
    return with_class.select("entity", "term", F.when(general < threshold, "generalise").otherwise("remove").alias("action"))


def sanitise(docs: DataFrame, prior: float = PRIOR, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``found``, all spans (kind, start, end) of every row: base kinds as listed, then
    ``generalise`` and ``remove``, each by start."""
    found = materialize(scan(docs), "found")
    words = telling(docs, found, prior, threshold)
    uses = found.select("key", F.explode("near").alias("x")).select("key", "x.entity", F.explode("x.terms").alias("t"))
    marked = uses.select("key", "entity", "t.*").join(words, ["entity", "term"]).groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct(F.col("action").alias("kind"), "start", "end"))).alias("more"))
    # A word named by two entities is removed if either asks for it.
    rest = F.filter("more", lambda s: (s["kind"] == "remove") | ~F.exists("more", lambda o: (o["kind"] == "remove") & (o["start"] == s["start"])))
    return found.join(marked, "key", "left").select(
        "doc_id", F.concat("base", F.coalesce(rest, F.array().cast(found.schema["base"].dataType))).alias("found"))


def replaced(text: str, spans) -> str:
    """The text with base spans named, generalised words put as their class and removed words gone."""
    out, at = [], 0
    for kind, a, b in sorted(((s["kind"], s["start"], s["end"]) for s in spans), key=lambda s: (s[1], s[2])):
        if a >= at:
            word = text[a:b]
            name = {"generalise": "number" if re.fullmatch(r"[0-9.,:/-]+", term(word)) else "word", "remove": ""}.get(kind, kind)
            out += [text[at:a], f"[{name}]" if name else ""]
            at = b
    return "".join(out) + text[at:]
