import math
import pickle
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from matchloom.llm import class_lm, mixing
from matchloom.llm.queries import QUERIES


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_base_scores(spark, sf, monkeypatch):
    monkeypatch.setattr(class_lm, "FREQUENT", 500)  # most words take the joined way
    docs = {r.doc_id: class_lm.tokens(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = Counter()
    for d, ws in docs.items():
        if crc(d) % 10:
            counts.update(ws)
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op10_class_lm"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = [*docs[r.doc_id], None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (crc(r.doc_id) % 10 == 0, len(ws), n)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # classes predict better than counts alone


def test_ways_agree(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model, counts = class_lm.train(docs)
    whole = {r.doc_id: r.score for r in class_lm.score(docs, model, counts).collect()}
    few = class_lm.Model(**{**model.__dict__, "words": model.words[:class_lm.OWN], "counts": model.counts[:class_lm.OWN]})
    for r in class_lm.score(docs, few, counts).collect():
        assert r.score == pytest.approx(whole[r.doc_id])


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(0)
    of = np.arange(24) % 3
    pairs = np.zeros((24, 24))
    for a in range(24):
        for b in range(24):
            pairs[a, b] = rng.poisson(40 if of[b] == (of[a] + 1) % 3 else 1)
    got = class_lm.exchange(pairs, 3)
    assert len({(x, y) for x, y in zip(of, got)}) == 3


def test_steps_are_probabilities(spark, sf):
    model, _ = class_lm.train(spark.read.parquet(f"{sf}/documents.parquet"))
    assert np.allclose((10 ** model.log_step).sum(axis=1), 1)
    sums = np.bincount(model.classes, 10 ** model.log_unit, class_lm.CLASSES)
    assert np.allclose(sums[np.unique(model.classes)], 1)


def test_every_word_gets_its_own_class(spark, monkeypatch):
    # Words of one ending, so of one bucket: half of them stand where the unit "noun" stands, half where "verb" does.
    monkeypatch.setattr(class_lm, "OWN", 4)
    monkeypatch.setattr(class_lm, "CLASSES", 6)
    rng = np.random.default_rng(1)
    nouns, verbs = [f"n{i}tion" for i in range(30)], [f"v{i}tion" for i in range(30)]
    texts = [" ".join(f"the {rng.choice([*nouns, *['noun'] * 9])} will {rng.choice([*verbs, *['verb'] * 9])}" for _ in range(40)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    around = class_lm.contexts(docs, spark.sparkContext.broadcast([b"the", b"will", b"noun", b"verb"]))
    classes = np.full(class_lm.UNITS, 5)
    classes[:4], classes[class_lm.OWN + class_lm.bucket(b"xtion")] = range(4), 4
    pairs = np.zeros((class_lm.UNITS, class_lm.UNITS))
    for r in around.filter("word IS NULL").collect():
        pairs[r.before, r.after] += r.n
    member = np.eye(class_lm.CLASSES)[classes]
    got = {r["word"]: (r["n"], r["class"]) for r in class_lm.word_classes(around, classes, member.T @ pairs @ member).collect()}
    said = Counter(w for t in texts for w in t.split() if w.endswith("tion"))
    assert {w: n for w, (n, _) in got.items()} == said
    assert {got[w][1] for w in nouns} == {2} and {got[w][1] for w in verbs} == {3}  # by their bucket, all would have one class


def test_moves_are_those_of_the_exchange():
    rng = np.random.default_rng(2)
    k, words = 5, 12
    pairs, of = rng.poisson(3, (words, words)).astype(float), rng.integers(0, k, words)
    f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0)

    def information(classes):
        table = np.eye(k)[classes].T @ pairs @ np.eye(k)[classes]
        return f(table).sum() - f(table.sum(axis=0)).sum() - f(table.sum(axis=1)).sum()

    member = np.eye(k)[of]
    other = pairs * (1 - np.eye(words))
    spread = lambda m: (np.repeat(np.arange(words), k), np.tile(np.arange(k), words), (m @ member).ravel())
    got = class_lm.best_classes(member.T @ pairs @ member, of, spread(other), spread(other.T), np.diag(pairs))
    for w in range(words):
        gains = [information(np.where(np.arange(words) == w, c, of)) for c in range(k)]
        assert gains[got[w]] == pytest.approx(max(gains))


def test_steps_count_every_word_in_its_class(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "FREQUENT", 4)  # all others are joined
    texts = ["a b c d a b e f a b c g", "a b h a b c d i j", None, "k k k a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model, counts = class_lm.train(docs)
    of = {r["word"]: r["class"] for r in counts.collect()}
    assert len(of) == 11
    end = int(model.classes[-1])
    expected = np.zeros((class_lm.CLASSES, class_lm.CLASSES))
    for t in texts:
        chain = [end, *[of[w] for w in (t or "").split()], end]
        for x, y in zip(chain, chain[1:]):
            expected[x, y] += 1
    got = class_lm.class_steps(class_lm.sequences(docs, model, counts), model)
    assert (got == expected).all()


def test_workers_need_no_copy_of_the_package(odd):
    model, _ = class_lm.train(odd)
    assert b"matchloom" not in pickle.dumps(vars(model))


def test_lm_odd_rows(odd):
    model, counts = class_lm.train(odd)
    rows = class_lm.score(odd, model, counts).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) and r.n_known == r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    empty, none = class_lm.train(odd.limit(0))
    rows = class_lm.score(odd, empty, none).collect()
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in rows)
    assert class_lm.score(odd.limit(0), model, counts).count() == 0


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = corpus_pipeline.load(spark, sf, "documents")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, sf)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == (docs.columns if name != "mix" else [*docs.columns, "rate", "copies"])
        gone = {r.doc_id for r in before.select("doc_id").collect()} - {r.doc_id for r in after.select("doc_id").collect()}
        if name == "quality":
            judged = [labels[d] for d in gone if d in labels]
            assert gone and judged.count(1) <= 0.05 * len(judged)
        elif name == "mix":
            assert not gone and 0 <= after.agg({"rate": "min"}).first()[0] and after.agg({"rate": "max"}).first()[0] <= mixing.LIMIT
        elif name in ("near_dedup", "decontaminate"):
            assert gone and len(gone) < 0.3 * before.count()
        else:
            assert not gone
        before = after


def test_pipeline_odd_rows(odd, spark, tmp_path, labels):
    for name, df in (("documents", odd), ("labels", labels)):
        df.write.parquet(str(tmp_path / "sf" / f"{name}.parquet"))
    spark.createDataFrame([(1, "")], "item_id bigint, text string").write.parquet(str(tmp_path / "sf" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "sf")).count() > 0
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path / "sf"))
        assert docs.count() == 0
