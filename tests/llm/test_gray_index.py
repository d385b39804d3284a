import random

import numpy as np
import xxhash
from matchloom.llm import gray_index, stars
from matchloom.llm.base import WORD
from matchloom.llm.queries import QUERIES


def slow_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def groups(fps):
    up = list(range(len(fps)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_query_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sorted(QUERIES["op9_gray_simhash"](spark, sf).collect())
    fps = [slow_print(docs[r.doc_id]) for r in rows]
    assert [int(r.fingerprint, 16) for r in rows] == fps and all(len(r.fingerprint) == 16 for r in rows)
    assert [r.component_id for r in rows] == [rows[g].doc_id for g in groups(fps)]


def test_linked_within_keys():
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(4)]
    made = {(rng.randrange(3), rng.choice(base) ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randrange(5))})) for _ in range(500)}

    def rank(f):
        for k in (1, 2, 4, 8, 16, 32):
            f ^= f >> k
        return f

    rows = sorted(made, key=lambda r: (r[0], rank(r[1])))
    keys, fps = np.array([k for k, _ in rows]), np.array([f for _, f in rows], np.uint64)
    got = gray_index.linked(keys, fps)
    for key in range(3):
        at = [i for i, r in enumerate(rows) if r[0] == key]
        assert [int(got[i]) for i in at] == [at[g] for g in groups([rows[i][1] for i in at])]


def test_pairs_meet_in_a_table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        f = rng.getrandbits(64)
        g = f ^ sum(1 << b for b in rng.sample(range(64), 3))
        rows.append((f - (1 << 64) if f >> 63 else f, g - (1 << 64) if g >> 63 else g))
    df = spark.createDataFrame(rows, "f bigint, g bigint")
    from pyspark.sql import functions as F

    met = df.select(F.size(F.array_intersect(gray_index.table_keys(F.col("f")), gray_index.table_keys(F.col("g")))).alias("n"))
    assert met.filter("n = 0").count() == 0


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 300)]
    got = dict(stars.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in range(200, 207)}}
    assert stars.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_odd_rows_and_survivors(odd):
    found = gray_index.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found if r.doc_id not in (3, None)}
    assert by[0].fp == by[1].fp == by[2].fp == 0 and {by[i].component_id for i in (0, 1, 2)} == {0}
    assert by[6].component_id == 5
    kept = gray_index.one_of_each(odd)
    assert kept.columns == odd.columns
    roots = {r.root for r in found}
    assert kept.count() == len(roots)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (0, 1, 2, 5, 6, 11)) == [0, 5, 11]
    assert gray_index.near_duplicates(odd.limit(0)).count() == 0 and gray_index.one_of_each(odd.limit(0)).count() == 0
