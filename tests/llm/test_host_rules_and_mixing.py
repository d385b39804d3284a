import pytest
from matchloom.llm import host_rules, mixing
from matchloom.llm.base import WORD
from matchloom.llm.queries import QUERIES
from pyspark.sql import functions as F


def slow_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures(spark, sf, odd):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd.filter("doc_id NOT IN (5, 6)")):
        texts = {}
        for r in docs.collect():
            texts.setdefault(r.doc_id, set()).add(slow_measures(r.text))
        got = {}
        for r in host_rules.measures(docs).collect():
            got.setdefault(r.doc_id, set()).add(tuple(r[n] for n in NAMES))
        assert got == texts


def test_query(spark, sf):
    rows = QUERIES["op2_host_rules"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_hosts_are_judged_and_shrunk(spark, text):
    good = [(i, text(40), f"h{i % 5}") for i in range(200)]
    bad = [(1000 + i, "few words" if i < 90 else text(40), "spam") for i in range(100)]
    lone = [(2000, "short", "new")]
    docs = spark.createDataFrame(good + bad + lone, "doc_id bigint, text string, source string")
    rows = {r.doc_id: r for r in host_rules.judge(docs).collect()}
    assert all(rows[i].kept for i in range(200))
    assert not any(rows[1000 + i].kept for i in range(100)) and rows[1095].host_rejected and not rows[1095].base_failed
    judged = docs.select(F.col("source").alias("host"), (F.length("text") < 20).alias("base_failed"))
    rates = {r.host: r.base_failed for r in host_rules.host_rates(judged, ["base_failed"]).collect()}
    assert rates["new"] < 1 and rates["spam"] > 0.8


def test_host_odd_rows(odd):
    rows = host_rules.judge(odd).collect()
    assert len(rows) == odd.count()
    assert not any(r.kept for r in rows if r.doc_id in (0, 1, 2))
    assert host_rules.judge(odd.limit(0)).count() == 0


def test_rates_meet_targets(spark, sf):
    mixed = QUERIES["op5_soft_mixing"](spark, "/root/testdata/sf0.01")
    total = mixed.agg(F.sum("tokens")).first()[0]
    got = mixed.agg(*[F.sum(F.col("tokens") * F.col(f"p_{d}") * F.col("rate")) / total for d in ("good", "poor", "toxic")]).first()
    assert list(got) == pytest.approx([0.92, 0.05, 0.03], abs=1e-4)
    assert mixed.filter("rate < 0 OR abs(p_good + p_poor + p_toxic - 1) > 1e-9").count() == 0
    assert mixed.count() == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()


def test_fit_against_plain_gradient(spark):
    rows = [(10 * (i % 7 + 1), [p := (i % 10) / 9, 1 - p]) for i in range(60)]
    steps = mixing.fit(spark.createDataFrame(rows, "tokens bigint, p array<double>"), [0.8, 0.2])
    total = sum(t for t, _ in rows)
    lam = [0.0, 0.0]
    for _ in range(20000):
        r = [max(0.0, 1 - p[0] * lam[0] - p[1] * lam[1]) for _, p in rows]
        have = [sum(t * p[k] * x for (t, p), x in zip(rows, r)) / total for k in (0, 1)]
        lam = [x + 0.3 * (h - t) for x, h, t in zip(lam, have, (0.8, 0.2))]
    want = [max(0.0, 1 - p[0] * lam[0] - p[1] * lam[1]) for _, p in rows]
    got = [max(0.0, 1 - p[0] * steps[0] - p[1] * steps[1]) for _, p in rows]
    assert got == pytest.approx(want, abs=1e-3)


def test_mixing_odd_rows(odd, labels, spark):
    domains = mixing.domain_labels(labels)
    targets = {"good": 0.9, "poor": 0.05, "toxic": 0.05}
    rows = mixing.mix(odd, domains, targets).collect()
    assert len(rows) == odd.count() and all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-9 for r in rows)
    out = mixing.mixed(odd, domains, targets)
    assert out.count() == odd.count() and out.columns == [*[c for c in odd.columns if c != "rate"], "rate", "copies"]
    assert mixing.mix(odd.limit(0), domains, targets).count() == 0
    assert {tuple(r.p) for r in mixing.mix(odd, domains.limit(0), targets).collect()} == {(1 / 3, 1 / 3, 1 / 3)}


def test_bounded_rates(spark):
    """Little of a domain is left: its documents, and empty texts, are not drawn more often than the bound says."""
    texts = [(i, "plain words of a good text " * 20, "good") for i in range(60)] + [(100, "vile rotten scum", "toxic"), (101, "", None), (102, None, None)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id bigint, text string")
    labelled = spark.createDataFrame([(i, d) for i, _, d in texts if d], "doc_id bigint, domain string")
    with pytest.warns(UserWarning, match="asked for"):
        rows = {r.doc_id: r for r in mixing.mixed(docs, labelled, {"good": 0.5, "toxic": 0.5}, limit=3.0).collect()}
    assert len(rows) == len(texts) and all(0 <= r.rate <= 3 and r.copies <= 3 for r in rows.values())
    assert rows[101].rate == rows[102].rate == 1.0 and rows[100].rate > 1
