import itertools

import numpy as np
import pytest
from matchloom.llm import quality_trees, toxic_spans
from matchloom.llm.base import remainder
from matchloom.llm.queries import QUERIES
from pyspark.sql import functions as F


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize("name,column,least", [("op1_quality_trees", "quality", 0.97), ("op8_toxic_field", "toxic", 0.9)])
def test_held_out(spark, name, column, least):
    sf = "/root/testdata/sf0.1"  # sf0.01 has 94 held-out labels, too few to judge rare toxic rows by
    table = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = table[table.held_out]
    assert auc(held["score"].to_numpy(), held[column].to_numpy()) > least


def test_trees_walk_like_nested_ifs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(quality_trees.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality_trees.grow(x, y, rounds=20, depth=3)
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.97

    def walk(node, row):
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        return trees.value[node]

    for row in x[:20]:
        raw = trees.base + sum(walk(r, row) for r in trees.roots)
        assert trees.scores(row[None])[0] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_quality_odd_rows(odd, labels):
    trees = quality_trees.train(odd, labels, remainder(3) != 1)
    rows = quality_trees.score(odd, trees).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    kept = quality_trees.keep(odd, trees, 0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert quality_trees.score(odd.limit(0), trees).count() == 0
    none = quality_trees.train(odd, labels.limit(0), F.lit(True))
    assert {r.score for r in quality_trees.score(odd, none).collect()} == {0.5}


def test_marginals_against_enumeration(monkeypatch):
    monkeypatch.setattr(toxic_spans, "BLOCK", 4)
    rng = np.random.default_rng(0)
    lengths, t = np.array([0, 3, 4, 5, 11, 1, 0, 9]), rng.normal(size=(2, 2))
    e, a = rng.normal(size=lengths.sum()) * 2, np.exp(t)
    pairs = np.zeros((2, 2))
    got = toxic_spans.marginals(e, lengths, t, pairs)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in lengths[lengths > 0]:
        x, at = e[at:at + n], at + n
        z, m, pp = 0.0, np.zeros(n), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=int(n)):
            w = (a[0, tags[0]] + a[1, tags[0]]) * np.exp(np.dot(x, tags)) * np.prod([a[i, j] for i, j in itertools.pairwise(tags)])
            z, m = z + w, m + w * np.array(tags)
            for i, j in itertools.pairwise(tags):
                pp[i, j] += w
        want += list(m / z)
        want_pairs += pp / z
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_toxic_odd_rows(odd, labels, spark, text):
    rows = [(i, text(60) + (" you idiot scum " if i % 5 == 0 else " ") + text(20)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    field = toxic_spans.train(docs, known, F.lit(True))
    found = {r.doc_id: r for r in toxic_spans.score(docs, field).collect()}
    assert all((found[i].score >= 0.3) == (i % 5 == 0) for i in range(200))
    assert {rows[0][1][s.start:s.end] for s in found[0].found} == {"you", "idiot", "scum"}  # "you" stands in toxic rows only
    for r in toxic_spans.score(odd, field).collect():
        assert 0 <= r.score <= 1
        assert (r.score >= 0.3) == (r.doc_id == 12)
    assert toxic_spans.score(odd.limit(0), field).count() == 0
    none = toxic_spans.train(odd, labels.limit(0), F.lit(True))
    assert {r.score for r in toxic_spans.score(odd, none).collect()} == {0.0}
