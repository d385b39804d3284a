"""Mixing to target weights with soft membership, in DataFrame operations only.

A labelled table names the domain of some documents. A naive Bayes classifier learnt from them gives
every document a posterior over domains (hashed words, each once per occurrence, with the evidence
of long texts tempered). Rates r >= 0 then make the expected tokens of each domain,
sum of r * tokens * posterior, meet target shares of all tokens: least squares by projected gradient.
A gradient step changes every rate by its posterior times one number per domain, so the steps add
up in one vector, and the rates are the projection max(0, 1 - posterior . steps): nothing is
kept per document, each iteration is one scan with as many sums as domains. Without bounds in
play this is the smallest change of rates (weighted by tokens) that meets the targets.

Rates can be bounded: documents that a target lacks most are then drawn ``limit`` times at most, so that a few scraps whose posterior
is but the prior do not stand in for a domain; what the targets miss by it is a warning.

Defined results: null text has no tokens, the prior as its posterior, and a rate like any other (1 with a bound); documents whose labels
disagree, or with a null domain, are not learnt from; without labelled documents the posterior
is flat; targets of domains without documents can't be met and the nearest mix is returned;
repeated rows count each and give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import fold, words
from matchloom.session import materialize

BUCKETS = 1 << 14
#: Bound on the labelled documents learnt from; so many (doc_id, domain) rows are broadcast.
MAX_ROWS = 20_000
LIMIT = 4.0  # times that ``mixed`` lets a document be drawn
EVIDENCE = 30.0  # the words of a text count as so many at most


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], max_rows: int = MAX_ROWS) -> tuple[list[float], DataFrame]:
    """Log priors, and a one-row table of the log weights of each bucket, ``w0``, ``w1``, ... by domain."""
    known = labelled.filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("domain").alias("domain"), F.max("domain").alias("_d")).filter("domain = _d").drop("_d")
    share = max_rows / max(1, known.count())
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(0.97 * share * 1_000_000))
    known = known.limit(max_rows)
    learnt = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    counted = materialize(
        learnt.select("domain", F.explode(words(fold(F.col("text")))).alias("w"))
        .groupBy(_bucket(F.col("w")).alias("b"), "domain").agg(F.count("*").alias("n")), "buckets")
    ids = {r[0]: r[1] for r in known.groupBy("domain").count().collect()}
    totals = {r[0]: r[1] for r in counted.groupBy("domain").agg(F.sum("n")).collect()}
    whole = sum(ids.values())
    priors = [math.log((ids.get(d, 0) + 1) / (whole + len(domains))) for d in domains]
    wide = counted.groupBy("b").agg(*[F.sum(F.when(F.col("domain") == d, F.col("n"))).alias(f"n{i}") for i, d in enumerate(domains)])
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(wide, "b", "left")
    weights = every.select("b", *[
        F.log((F.coalesce(f"n{i}", F.lit(0)) + 0.5) / F.lit(totals.get(d, 0) + 0.5 * BUCKETS)).alias(f"w{i}") for i, d in enumerate(domains)])
    one = weights.agg(F.array_sort(F.collect_list(F.struct("b", *[f"w{i}" for i in range(len(domains))]))).alias("x"))
    return priors, materialize(one.select(*[F.col(f"x.w{i}").alias(f"w{i}") for i in range(len(domains))]), "weights")


def posteriors(docs: DataFrame, priors: list[float], weights: DataFrame) -> DataFrame:
    """``doc_id``, ``h`` (hash of the text), ``tokens`` and ``p``, the posterior of each domain, of every row."""
    k = len(priors)
    tables = [weights.select(f"w{i}").scalar() for i in range(k)]
    # Hash and words in a step of their own: beside the generator they would be computed once per word.
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", F.xxhash64(text).alias("h"), words(fold(text)).alias("ws"))
    each = keyed.select("key", "doc_id", "h", F.explode_outer("ws").alias("w"))
    bucket = _bucket(F.col("w"))
    summed = each.groupBy("key", "doc_id", "h").agg(
        F.count("w").alias("tokens"),
        *[F.sum(F.when(F.col("w").isNotNull(), F.get(t, bucket))).alias(f"s{i}") for i, t in enumerate(tables)])
    temper = F.when(F.col("tokens") > EVIDENCE, EVIDENCE / F.col("tokens")).otherwise(1.0)
    logs = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) * temper + F.lit(priors[i]) for i in range(k)]
    top = F.greatest(*logs) if k > 1 else logs[0]
    odds = F.transform(F.array(*logs), lambda x: x)
    raw = summed.select("doc_id", "h", "tokens", odds.alias("l"), top.alias("m"))
    exp = raw.select("doc_id", "h", "tokens", F.transform("l", lambda x: F.exp(x - F.col("m"))).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return exp.select("doc_id", "h", "tokens", F.transform("e", lambda x: x / total).alias("p"))


def rate(p: Column, steps: list[float], limit: float | None = None, tokens: Column | None = None) -> Column:
    """max(0, 1 - p . steps), at most ``limit``; with ``tokens``, 1 for a text without any, as it moves no domain."""
    moved = F.lit(1.0)
    for i, s in enumerate(steps):
        moved = moved - F.get(p, i) * F.lit(float(s))
    bounded = F.greatest(F.lit(0.0), moved)
    if limit is not None:
        bounded = F.least(bounded, F.lit(float(limit)))
    return bounded if tokens is None else F.when(tokens > 0, bounded).otherwise(1.0)


def fit(members: DataFrame, targets: list[float], rounds: int = 80, close: float = 1e-6, limit: float | None = None) -> list[float]:
    """The summed steps after which expected tokens per domain meet ``targets`` (shares of all tokens). What is still missed after so many
    rounds, or with rates up to ``limit`` can't be met, is a warning with the shares."""
    k = len(targets)
    mass = members.agg(F.coalesce(F.sum("tokens"), F.lit(0)), *[
        F.coalesce(F.sum(F.col("tokens") * F.get("p", i)), F.lit(0.0)) for i in range(k)]).first()
    if not mass[0]:
        return [0.0] * k
    share = [m / mass[0] for m in mass[1:]]
    steps, have = [0.0] * k, share
    for _ in range(rounds):
        miss = [h - t for h, t in zip(have, targets)]
        if max(map(abs, miss)) < close:
            break
        # Each domain's step is scaled by its mass: a diagonal metric in which unit steps are safe.
        steps = [s + m / max(x, 1e-9) for s, m, x in zip(steps, miss, share)]
        r = rate(F.col("p"), steps, limit)
        got = members.agg(*[F.sum(F.col("tokens") * F.get("p", i) * r) for i in range(k)]).first()
        before, have = have, [x / mass[0] for x in got]
        if limit is not None and max(abs(a - b) for a, b in zip(have, before)) < close / 10:
            break  # at the bounds
    if max(abs(h - t) for h, t in zip(have, targets)) >= 1e-3:
        warnings.warn(f"domain shares {have} where {targets} were asked for", stacklevel=2)
    return steps


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], max_rows: int = MAX_ROWS, limit: float | None = None) -> DataFrame:
    """``doc_id``, ``h``, ``tokens``, ``p`` (posteriors in the order of ``targets``) and ``rate`` of every row."""
    domains, total = list(targets), sum(targets.values())
    priors, weights = train(docs, labelled, domains, max_rows)
    members = materialize(posteriors(docs, priors, weights), "posteriors")
    steps = fit(members, [targets[d] / total for d in domains], limit=limit)
    return members.withColumn("rate", rate(F.col("p"), steps, limit, None if limit is None else F.col("tokens")))


def domain_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``domain`` of the labelled table: toxic, good or poor."""
    return labels.filter(F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1)).select("doc_id", F.when(
        F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor").alias("domain"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], limit: float = LIMIT) -> DataFrame:
    """All documents with their ``rate``, ``limit`` at most, and with ``copies``, whole numbers that meet the rates on
    average: the fraction is rounded by a hash of the row. A sampler draws by these columns; no row is repeated or left out here.
    Input columns of these two names are replaced. A text without words gets the rate 1."""
    known = mix(docs, labelled, targets, limit=limit).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.col("rate").alias("_r")).groupBy(
        "_id", "_h").agg(F.max("_r").alias("_r"))
    text = F.coalesce(docs["text"], F.lit(""))
    joined = docs.join(known, docs["doc_id"].eqNullSafe(known["_id"]) & (F.xxhash64(text) == known["_h"]))
    dice = F.pmod(F.xxhash64(known["_id"], known["_h"], F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    return joined.select(*[docs[c] for c in docs.columns if c.lower() not in ("rate", "copies")], known["_r"].alias("rate"), F.floor(known["_r"] + dice).cast("int").alias("copies"))
