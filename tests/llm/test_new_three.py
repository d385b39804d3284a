"""Term divergence, byte-pair encoding and conversation repair: odd input, brute force, and pieces far smaller than usual."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from matchloom.llm import auction_repair, bpe, term_pointers
from matchloom.llm.queries import QUERIES
from tokenizers import Tokenizer

BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_FILE)


def test_encoder_against_library(library):
    encoder, rng = bpe.Encoder(bpe.Vocabulary(BYTE_FILE)), random.Random(3)
    parts = ["a", "b", "the", "  ", "\n", " ", "é", "ß", "1", "23", "!", "...", "<|endoftext|>", "<|end", "՘", "\U0003D000", "\U00010D40",
             "日本", "😀", "'s", "'LL", "\xa0", "zz", "er", "in", "\x00", "\x1c", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzeeeaaatt") for _ in range(rng.randint(1, 300))) for _ in range(2000)]
    texts += ["a" * 20_000, " " * 20_000, "ab" * 10_000, "=-" * 5000, "", "\n" * 999 + "x"]
    assert [encoder.encode(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_encoder_with_tables_emptied_all_the_time(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    encoder = bpe.Encoder(bpe.Vocabulary(BYTE_FILE))
    text = "Emptied tables change nothing, nothing, nothing at all; unbelievably so."
    assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bpe_query_and_round_trip(spark, odd, library, sf):
    rows = {r.doc_id: r for r in QUERIES["op12_backtracking_bpe"](spark, sf).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        coded = b"".join(x.to_bytes(4, "little") for x in ids)
        told = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), hashlib.sha256(coded).hexdigest(), told)
    back = bpe.decode(bpe.encode(odd, BYTE_FILE), BYTE_FILE).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect())
    assert bpe.encode(odd.limit(0), BYTE_FILE).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>"), BYTE_FILE).collect() == [(1, ""), (2, "")]


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def _terms(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c >= "\x80" or "a" <= c <= "z" else " " for c in text)
    return [t for t in fold.split(" ") if t]


def _audit(rows):
    kept, counts, groups = defaultdict(lambda: defaultdict(int)), defaultdict(Counter), set()
    for lang, source, text in rows:
        groups.add((lang, source))
        found = Counter(_terms(text))
        counts[lang, source].update(found)
        for t in found:
            kept[lang][t] += 1
    out = set()
    for lang, source in groups:
        words = [t for t, n in kept[lang].items() if n >= 3]
        whole = Counter()
        for (g, _), c in counts.items():
            if g == lang:
                whole.update({t: c[t] for t in words})

        def share(c):
            total = sum(c[t] for t in words)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(words)) for t in words}

        mine, all_of_it = share(counts[lang, source]), share(whole)
        pairs = [(sum((mine[t] - q[t]) ** 2 // q[t] for t in words), other) for g, other in groups if g == lang and other != source
                 for q in [share(counts[lang, other])]]
        terms = [((mine[t] - all_of_it[t]) ** 2 // all_of_it[t], t) for t in words if counts[lang, source][t] and mine[t] > all_of_it[t]]
        for part, values in (("pair", pairs), ("term", terms)):
            ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < 200}
    return out


def test_divergence_of_odd_rows(spark, odd):
    rng = random.Random(4)
    words = ["Ärger", "ab", "abc", "abcdefgh", "abcdefghi", "abcdefghijklmnopqrs", "abcdefghijklmnopqrt", "ß", "x", "日本語の言葉"]
    rows = [(rng.choice(["en", None, "de"]), rng.choice(["a", "b", None, "ü"]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for _ in range(120)]
    rows += [("xx", "only", "word"), ("yy", "a", ""), ("yy", "b", None), ("en", "none", "1 2 3")]
    table = spark.createDataFrame(rows, "lang string, source string, text string").unionByName(odd.select("lang", "source", "text")).withColumn("n", pa_one())
    plain = [(r.lang or "", r.source or "", r.text or "") for r in table.collect()]
    got = [tuple(r) for r in term_pointers.audit(table).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == _audit(plain)
    assert ("yy", "a", "pair", "b", 0, 1) in got
    assert term_pointers.audit(table.limit(0)).count() == 0


def pa_one():
    from pyspark.sql import functions as F

    return F.lit(1)


def test_runs_of_a_shard_and_blocks_of_pairs(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"lang": ["e", "e", "e"], "source": ["s", "s", "t"], "text": ["Ab ab é", "abé AB", "é" * 9 + " ab"]})
    got = term_pointers.counted(batch).to_pylist()
    assert {tuple(r.values()) for r in got} == {("e", "s", "ab", 3, 2), ("e", "s", "abé", 1, 1), ("e", "s", "é", 1, 1), ("e", "t", "é" * 9, 1, 1), ("e", "t", "ab", 1, 1)}
    held = [[{"source": s, "p": 10 * i + k, "p0": 3 + k} for k, s in enumerate("abcd")] for i in range(1, 5)]
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("p0", pa.int64())]))
    rows = pa.RecordBatch.from_arrays([pa.array(["e"] * 4), pa.array(held, kind)], names=["lang", "held"])
    whole = [b.to_pylist() for b in term_pointers.corrections(iter([rows]))]
    monkeypatch.setattr(term_pointers, "PAIRS", 1)
    order = lambda x: sorted(map(str, x[0]))
    assert order(whole) == order([b.to_pylist() for b in term_pointers.corrections(iter([rows]))]) and len(whole[0]) == 12


def _plain_best(kinds):
    """Least (cost, letters) by going back over the rows."""
    n, best = len(kinds) // 2, {}
    for i in range(n, -1, -1):
        base = {}
        for q in auction_repair.STATES:
            options = [(0, "")] if i == n and q in auction_repair.GOOD_ENDS else []
            if i < n:
                initial, fault = kinds[2 * i], kinds[2 * i + 1]
                extra, moves = 5 * (fault == "t"), [(2, q, "D")]
                if fault != "d":
                    moves += [(1 + extra, auction_repair.NEXT[r].get(q), "R") for r in "ua"] + [(extra, auction_repair.NEXT[initial].get(q), "K")]
                options = [(c + best[i + 1, x][0], letter + best[i + 1, x][1]) for c, x, letter in moves if x is not None and best[i + 1, x]]
            base[q] = min(options, default=None)
        for q in auction_repair.STATES:
            options = [base[q]] if base[q] else []
            for roles in ("u", "a", "ua", "au"):
                x = q
                for r in roles:
                    x = auction_repair.NEXT[r].get(x)
                if x is not None and base[x]:
                    options.append((base[x][0] + 5 * len(roles), "I" * len(roles) + base[x][1]))
            best[i, q] = min(options, default=None)
    return best[0, auction_repair.START]


def test_auction_against_plain_recursion():
    rng, blocks = random.Random(6), auction_repair.Blocks()
    for size in [*range(40)] * 6 + [200, 500]:
        kinds = "".join(rng.choice("ssuuuuaaaax-") + rng.choice("kkkkdt") for _ in range(size))
        assert blocks.repair(kinds) == _plain_best(kinds)


def _repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation's rows before damage."""
    after = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        after += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), ""
    for _, role, text in after:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults += "b" if not bare else "d" if (role, text) in seen else "k" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
    roles = [r for _, r, _ in after]
    cost, audit = _plain_best(auction_repair.kinds_of(roles, faults))
    turns = {t for t, _, _ in after if t is not None}
    lines = "\n".join(auction_repair.lines(roles, [t for _, _, t in after], audit))
    wrong = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(faults.count, "bdt"), wrong, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def _table(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "", "tool", "User"]) if rng.random() < .3 else ["user", "assistant"][t % 2],
             rng.choice(["Fine.", "Fine.", "cut", None, "", " \n", "long " * 50 + "end!", "ok?\t\n"])) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(7, None, "user", "no turn."), (7, 3, "user", "same turn."), (None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (None, None, None, None)]
    rows += [(1000, t, ["user", "assistant"][t % 2], f"text {t % 97}.") for t in range(900)] + [(1001, 0, "user", "twice.")] * 3
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, part int, no int")


@pytest.mark.parametrize("segment, block", [(240, 12), (3, 2)])
def test_repair_of_odd_conversations(spark, monkeypatch, segment, block):
    monkeypatch.setattr(auction_repair, "SEGMENT", segment)
    monkeypatch.setattr(auction_repair, "BLOCK", block)
    rows, table = _table(spark)
    wanted = defaultdict(list)
    for r in rows:
        wanted[r[0]].append(r)
    got = auction_repair.repair(table).collect()
    assert len(got) == len(wanted)
    for r in got:
        assert tuple(r)[1:] == _repaired(wanted[r.conv_id]), r.conv_id
    assert auction_repair.repair(table.limit(0)).count() == 0


def test_repair_spread_over_many_tasks(spark, monkeypatch):
    """A conversation that holds most rows, dealt over tasks."""
    monkeypatch.setattr(auction_repair, "SEGMENT", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows, table = _table(spark)
        got = {r.conv_id: tuple(r)[1:] for r in auction_repair.repair(table).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[1000] == _repaired([r for r in rows if r[0] == 1000])
