import random

import corpus_pipeline
from matchloom.llm import gray_index, near_copies


def grams(t):
    w = (t or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def slow(rows):
    """Rows that stay: components of Jaccard >= 0.8 by brute force, the smallest doc_id of each."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def test_stage_keeps_one_of_each_component_of_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(60, 400))]
        texts.append(base)
        for _ in range(5):  # similarities from about 0.5 to 0.97, also of copies of copies
            t = list(rng.choice(texts[-3:]))
            for _ in range(rng.randrange(1, max(2, len(t) // 35))):
                t[rng.randrange(len(t))] = word()
            texts.append(t)
    shared = [word() for _ in range(100)]
    texts += [shared + [word() for _ in range(15)] for _ in range(40)]  # one common passage, near 0.7 to each other
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000, ""), (1001, " \n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    want = slow(rows)
    assert got == want and len(want) < len(rows) - 20


def test_documents_at_the_bound(spark):
    base = [f"a{i}" for i in range(94)]  # 90 shingles
    at = base[:84]  # 80 of 90 in common
    pairs = [(1, " ".join(base)), (2, " ".join(at))]
    assert len(near_copies.shingles(pairs[0][1], 5)) == 90
    assert {r.doc_id for r in near_copies.one_of_each(spark.createDataFrame(pairs, "doc_id bigint, text string"), 5).collect()} == {1}
    exact = [(1, " ".join(base)), (2, " ".join(base[:76])), (3, " ".join(base[:75]))]  # 72 and 71 of 90
    assert {r.doc_id for r in near_copies.one_of_each(spark.createDataFrame(exact[:2], "doc_id bigint, text string"), 5).collect()} == {1}
    assert {r.doc_id for r in near_copies.one_of_each(spark.createDataFrame([exact[0], exact[2]], "doc_id bigint, text string"), 5).collect()} == {1, 3}


def test_near_copies_odd_rows(odd):
    kept = near_copies.one_of_each(odd, 5)
    assert kept.columns == odd.columns and near_copies.one_of_each(odd.limit(0), 5).count() == 0
    rows = kept.collect()
    assert sum(not (r.text or "").strip() for r in rows) == 1 and any(r.doc_id is None for r in rows)


def test_gray_tables_give_pairs_without_minima(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(4000)}" for _ in range(3000)]
    near = [*base[:-1], "other"]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(f"v{i}" for i in range(300)))]
    prints = [gray_index.fingerprint(t, 5) for _, t in rows]
    assert bin((prints[0] ^ prints[1]) & (1 << 64) - 1).count("1") <= gray_index.LIMIT
    assert prints == [gray_index.fingerprint_of(near_copies.shingle_hashes(t, 5)) for _, t in rows]
    monkeypatch.setattr(near_copies, "band_keys", lambda hashes: hashes[:0].view("int64"))  # no minima at all
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in near_copies.one_of_each(docs, 5).collect()} == {1, 3}
