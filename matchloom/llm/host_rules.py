"""Quality rules with a memory of hosts, in DataFrame operations only.

Every document is measured and tested by document rules. Failures are added up per host (the
``source``); each host's failure rate of a rule is shrunk towards the rate of all hosts by a beta
prior whose mean and strength are fitted to the hosts (by moments). A host whose shrunk rate of
base failures reaches ``reject`` loses all its documents; a host whose shrunk rate of another rule
reaches ``suspect`` loses the documents that fail that rule. Host verdicts come back by a join on
host and salt, so that a host with a third of all rows is spread over tasks.

Defined results: null text has no words and fails the base rule; a null source is a host of
its own; repeated rows count each and give repeated results; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.expr import let
from matchloom.llm.base import BLANKS, words
from matchloom.session import materialize

SALTS = 16
WINDOW = 8
#: Rules beside the base rule: name and condition over the measures.
RULES = {
    "symbols": "n_symbols > 0.3 * n_words",
    "dup_lines": "n_lines > 3 AND n_dup_lines > 0.3 * n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
}


def repeated_words(found: Column) -> Column:
    """How many words lie in a window of WINDOW words that occurs twice or more in the text.

    The second of two equal windows of eight words holds five windows of four that were there before, so texts
    with fewer than five repeated windows of four are done. In the others all windows are hashed and
    sorted to find the equal ones; their positions then give the words covered."""
    def grams(ws: Column, n: int) -> Column:
        each = F.transform(ws, lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, n)]))
        return F.slice(each, F.lit(1), F.size(ws) - (n - 1))

    def covered(h: Column) -> Column:
        return let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), lambda s: let(
            F.array_sort(F.filter(F.transform(s, lambda e, k: F.when(
                F.coalesce(e["x"] == F.get(s, k - 1)["x"], F.lit(False)) | F.coalesce(e["x"] == F.get(s, k + 1)["x"], F.lit(False)),
                e["i"])), lambda p: p.isNotNull())),
            lambda at: F.aggregate(
                at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
                lambda acc: acc["n"])))

    def counted(ws: Column) -> Column:
        few = let(grams(ws, WINDOW // 2), lambda h: F.size(h) - F.size(F.array_distinct(h)) <= WINDOW // 2)
        return F.when((F.size(ws) <= WINDOW) | few, F.lit(0)).otherwise(let(grams(ws, WINDOW), covered))

    # Bound once: inside the lambdas the words are then a variable, not an expression to be evaluated anew.
    return F.when(F.size(found) <= WINDOW, F.lit(0)).otherwise(let(found, counted)).cast("bigint")


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``host`` and the counts of every row."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", F.col("source").alias("host"), text.alias("text"), words(text).alias("ws"))
    no_blanks = F.translate("text", BLANKS, "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return split.select(
        "doc_id", "host", F.size("ws").cast("bigint").alias("n_words"),
        F.length(no_blanks).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n"), F.size(F.array_distinct(x)).cast("bigint").alias("d"))).alias("_l"),
        repeated_words(F.col("ws")).alias("n_repeat_words"),
    ).select("doc_id", "host", "n_words", "word_chars", "n_symbols", F.col("_l.n").alias("n_lines"),
             (F.col("_l.n") - F.col("_l.d")).alias("n_dup_lines"), "n_repeat_words")


def host_rates(judged: DataFrame, rules: list[str]) -> DataFrame:
    """``host``, ``n`` and the shrunk failure rate of each rule.

    With m the overall rate and v the variance of host rates beyond chance, a beta prior with mean m
    and strength m(1-m)/v - 1 (between 1 and 10 000) stands for what is known before a host is seen."""
    hosts = judged.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("int")).alias(r) for r in rules])
    whole = hosts.agg(*[F.struct(
        (F.sum(r) / F.sum("n")).alias("m"),
        (F.avg(F.pow(F.col(r) / F.col("n"), 2)) - F.pow(F.avg(F.col(r) / F.col("n")), 2)).alias("v"),
        F.avg(1 / F.col("n")).alias("k")).alias(r) for r in rules]).first()
    prior = {}
    for r in rules:
        m, v, k = (whole[r][x] or 0.0 for x in ("m", "v", "k"))
        beyond = v - m * (1 - m) * k
        strength = min(10_000.0, max(1.0, m * (1 - m) / beyond - 1)) if beyond > 0 else 10_000.0
        prior[r] = (m * strength, strength)
    return hosts.select("host", "n", *[((F.col(r) + F.lit(a)) / (F.col("n") + F.lit(s))).alias(r) for r, (a, s) in prior.items()])


def judge(docs: DataFrame, reject: float = 0.5, suspect: float = 0.5) -> DataFrame:
    """Measures, ``base_failed``, ``host_rejected``, ``failed`` (names of further rules failed) and
    ``kept`` of every row."""
    base = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    measured = materialize(measures(docs), "measures")
    judged = measured.withColumns({"base_failed": base, **{f"_{r}": F.expr(c) for r, c in RULES.items()}})
    rates = host_rates(judged.withColumnsRenamed({f"_{r}": r for r in RULES}), ["base_failed", *RULES])
    verdicts = rates.select(
        F.col("host").alias("_host"), (F.col("base_failed") >= reject).alias("host_rejected"),
        *[(F.col(r) >= suspect).alias(f"_{r}_host") for r in RULES],
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = judged.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = salted.join(verdicts, F.col("host").eqNullSafe(F.col("_host")) & (F.col("salt") == F.col("_salt")))
    failed = F.filter(F.array(*[F.when(F.col(f"_{r}"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    by_host = F.lit(False)
    for r in RULES:
        by_host = by_host | (F.col(f"_{r}") & F.col(f"_{r}_host"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rejected",
        failed.alias("failed"), (~F.col("base_failed") & ~F.col("host_rejected") & ~by_host).alias("kept"))
