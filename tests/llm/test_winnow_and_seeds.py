import numpy as np
import pytest
from matchloom.llm import spaced_seeds, winnow
from matchloom.llm.base import WORD
from matchloom.llm.queries import QUERIES


def test_cut_is_linear_and_whole():
    t = "One two. Three four five six seven eight nine ten eleven twelve thirteen\nfour. " + "x" * 20_000 + "! a b"
    spans, hashes = winnow.cut(t)
    assert [t[a:b] for a, b in spans] == ["One two. Three four five six seven eight nine ten", "eleven twelve thirteen", "four. " + "x" * 20_000 + "! a b"]
    assert " ".join(" ".join(WORD.findall(t[a:b])) for a, b in spans) == " ".join(WORD.findall(t)) and len(hashes) == len(spans)


def test_every_long_common_run_shares_a_fingerprint():
    rng = np.random.default_rng(0)
    for _ in range(200):
        run = rng.integers(0, 1 << 62, winnow.WINDOW + 1)
        a = np.r_[rng.integers(0, 1 << 62, rng.integers(0, 9)), run, rng.integers(0, 1 << 62, rng.integers(0, 9))]
        b = np.r_[rng.integers(0, 1 << 62, rng.integers(0, 9)), run, rng.integers(0, 1 << 62, rng.integers(0, 9))]
        assert set(winnow.fingerprints(a)[1]) & set(winnow.fingerprints(b)[1])


def test_passages_go_and_first_copies_stay(spark, text):
    passage = text(66)
    rows = [(i, f"{text(50)}\n{passage}\n{text(50)}") for i in range(30)]
    rows += [(100 + i, text(120)) for i in range(20)]
    rows += [(200, (p := text(60)) + "\n" + text(40) + "\n" + p)]
    rows += [(300, rows[30][1])]  # a whole copy
    out = {r.doc_id: r for r in winnow.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), report=True).collect()}
    assert len(out) == len(rows) and out[0].text == rows[0][1]
    lines = passage.split("\n")
    for i in range(1, 30):
        assert passage not in out[i].text and len(WORD.findall(out[i].text)) >= 95 and out[i].cut >= 5, lines
    assert all(out[100 + i].text == rows[30 + i][1] for i in range(20))
    assert out[200].text.count(p) == 1 and out[300].text == ""


def test_every_deleted_piece_was_there_before(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen, cuts = set(), 0
    for r in sorted(QUERIES["op4_winnowed_lines"](spark, "/root/testdata/sf0.01").collect()):
        spans, _ = winnow.cut(texts[r.doc_id])
        gone = [tuple(map(int, s.split(":"))) for s in r.removed.split(",") if s]
        for a, b in spans:
            piece = texts[r.doc_id][a:b]
            if any(x <= a and b <= y for x, y in gone):
                assert piece in seen
                cuts += 1
            seen.add(piece)
        if not gone:
            assert r.text == texts[r.doc_id]
    assert cuts > 0


def test_winnow_odd_rows(odd):
    out = winnow.dedup(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = {(r.doc_id, r.source, r.text) for r in out.collect()}
    assert (0, None, None) in texts and (6, None, "") in texts
    assert winnow.dedup(odd.limit(0)).count() == 0
    numbers = out.filter("doc_id = 6").first()
    assert numbers.n_chars == 0


def slow_overlap(doc, item, least=0.8):
    fold = lambda t: ["".join(c for c in w.lower() if not (c.isascii() and not c.isalnum())) for w in WORD.findall(t)]
    d, i = [w for w in fold(doc) if w], [w for w in fold(item) if w]
    best = max((sum(0 <= s + k < len(d) and d[s + k] == w for k, w in enumerate(i)) for s in range(-len(i), len(d))), default=0)
    return best >= least * len(i) and len(i) >= spaced_seeds.SPAN


def test_seeds_query_finds_the_items_held(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_spaced_seeds"](spark, sf).collect()}
    some = {d: set(docs[d].lower().split()) for d in docs}
    want = {(d, i) for i, t in items.items() for d in docs
            if len(some[d] & set(t.lower().split())) >= 0.5 * len(set(t.lower().split())) and slow_overlap(docs[d], t)}
    assert got == want and got


@pytest.mark.parametrize("every,held", [(0, True), (7, True), (5, True), (3, False)])
def test_substitutions(spark, text, every, held):
    item = text(40).replace(".", "")
    words = ["xyzzy" if every and k % every == every - 1 else w for k, w in enumerate(item.split())]
    docs = spark.createDataFrame([(1, f"{text(30)}\n{' '.join(words).upper()}! {text(30)}"), (2, text(90)), (None, item)], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, item), (10, None), (11, "too short")], "item_id bigint, text string")
    rows = spaced_seeds.overlaps(docs, items).collect()
    assert {r.doc_id for r in rows} == ({1, None} if held else {None}) and {r.item_id for r in rows} == {9}
    assert {r.doc_id for r in spaced_seeds.clean(docs, items).collect()} == ({2} if held else {1, 2})


def test_items_are_found_wherever_they_stand(spark, text):
    item = text(24)
    docs = spark.createDataFrame([(i, f"{text(i)} {item} {text(40)}") for i in range(1, 40)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert spaced_seeds.overlaps(docs, items).count() == 39


def test_seeds_odd_rows(odd, spark):
    items = spark.createDataFrame([(1, "no id here but words enough to be kept by all of them"), (2, None)], "item_id bigint, text string")
    rows = spaced_seeds.overlaps(odd, items).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(None, 1)]
    assert spaced_seeds.clean(odd, items).count() == odd.count() - 1
    assert spaced_seeds.clean(odd, items.limit(0)).count() == odd.count()
    assert spaced_seeds.overlaps(odd.limit(0), items).count() == 0
