import random

import numpy as np
from matchloom.llm import winnow


def words_of(rng, n):
    return [f"{rng.choice('bcdfglmnprst')}{rng.randrange(3000)}" for _ in range(n)]


def left_over(out, run, lost=8):
    """Words of the middle of a run (without ``lost`` at each edge) that a text still holds in a row of five."""
    t = " ".join(out.split())
    return [i for i in range(lost, len(run) - lost - 4) if " ".join(run[i:i + 5]) in t]


def test_long_runs_are_cut_alike_whatever_stands_before():
    rng = random.Random(2)
    for _ in range(300):
        run = words_of(rng, 51)
        cuts = []
        for n in (rng.randrange(30), rng.randrange(30)):
            t = " ".join(words_of(rng, n) + run + words_of(rng, rng.randrange(30)))
            cuts.append({t[a:b] for a, b in winnow.cut(t)[0]})
        common = [p for p in cuts[0] & cuts[1] if set(p.split()) <= set(run)]
        assert sum(len(p.split()) for p in common) >= winnow.LEAST


def test_repeated_runs_go_from_anywhere_in_a_line(spark):
    rng = random.Random(4)
    rows, runs = [], []
    for i in range(120):
        run = words_of(rng, rng.randrange(60, 120))
        runs.append(run)
        for k in range(2):
            before, behind = words_of(rng, rng.randrange(40)), words_of(rng, rng.randrange(40))
            if k and before:
                before[-1] += "."  # a short sentence ends before it
            rows.append((2 * i + k, " ".join(before + run + behind)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in winnow.dedup(docs).collect()}
    assert all(out[2 * i] == rows[2 * i][1] for i in range(120))
    assert [i for i, run in enumerate(runs) if left_over(out[2 * i + 1], run, 12)] == []


def test_pieces_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("ab é\n\t.x "), rng.integers(0, 90))) for _ in range(50)]
    a, b, words, hashes, bounds = winnow.pieces_in(texts)
    for t, i, j in zip(texts, bounds[:-1], bounds[1:]):
        spans, own = winnow.cut(t)
        assert spans == list(zip(a[i:j].tolist(), b[i:j].tolist())) and own.tolist() == hashes[i:j].tolist()
        assert words[i:j].tolist() == [len(t[x:y].split()) for x, y in spans] and sum(words[i:j]) == len(t.split())


def slow_deletions(rows, least):
    """Characters deleted by brute force: every piece in ``least`` words of pieces that stand earlier, as strings."""
    seen, gone = set(), {}
    for i, t in sorted(rows):
        spans, _ = winnow.cut(t)
        cut = [t[a:b] for a, b in spans]
        drop = set()
        for a in range(len(cut)):
            for b in range(a + 1, len(cut) + 1):
                if sum(len(p.split()) for p in cut[a:b]) >= least:
                    if tuple(cut[a:b]) in seen:
                        drop |= set(range(a, b))
                    seen.add(tuple(cut[a:b]))
                    break
        gone[i] = len(drop)
    return gone


def test_frequent_lines_inside_longer_passages(spark):
    rng = random.Random(6)
    licence = " ".join(words_of(rng, 18))
    rows = [(i, " ".join(words_of(rng, 30)) + "\n" + licence + "\n" + " ".join(words_of(rng, 30))) for i in range(30)]
    for i in range(30, 60):  # copies of a passage around the licence, that the first document of it does not have
        rows.append((i, " ".join(words_of(rng, 9)) + "\n" + "\n".join(rows[i - 20][1].split("\n")[:2]) + "\n" + " ".join(words_of(rng, 25))))
    rows += [(60, "same again " * 90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r for r in winnow.dedup(docs, report=True).collect()}
    assert {i: r.cut for i, r in out.items()} == slow_deletions(rows, winnow.LEAST)
    assert all(licence not in out[i].text for i in range(30, 60)) and all(out[i].cut == 0 for i in range(30))


def test_windows_choose_the_least_of_their_pairs():
    rng = np.random.default_rng(3)
    for two in (True, False):
        for _ in range(200):
            n = int(rng.integers(1, 60))
            hashes = rng.integers(-4, 4, n)  # many ties
            at = np.arange(n)
            end = np.minimum(n, at + rng.integers(2, 9, n)) if two else np.minimum(n, at + rng.integers(1, 9, n))
            end = np.maximum.accumulate(end)
            fits = end - at >= (2 if two else 1)
            at, end = at[fits], end[fits]
            place, prints = winnow.chosen(hashes, at, end, two)
            values = prints.view(np.uint64)
            for a, b, p in zip(at, end, place):
                inside = values[a:b - two]
                assert p == a + len(inside) - 1 - int(inside[::-1].argmin())


def test_a_later_partner_counts(spark):
    rng = random.Random(8)
    common = [" ".join(words_of(rng, 20)) for _ in range(6)]
    # The first documents have every common line alone; 10 and 11 share all of them in one order.
    rows = [(i, " ".join(words_of(rng, 30)) + "\n" + c + "\n" + " ".join(words_of(rng, 30))) for i, c in enumerate(common)]
    rows += [(i, " ".join(words_of(rng, 12)) + "\n" + "\n".join(common)) for i in (10, 11)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in winnow.dedup(docs).collect()}
    assert out[10] == rows[6][1] and out[11] == rows[7][1].split("\n")[0]
