import hashlib
import re

from matchloom.llm import disclosure
from matchloom.llm.queries import QUERIES


def brute(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_base_spans_on_tricky_texts():
    for t in ["a@b.c@d.e", "x@y", "a.b+c@d-e.f.g, q@@r.s t@u.v.", "@a.b", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.256 01.002.0003.4", "é@b.c ab@c.d@",
              "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (234) 567-8901 +12 +1--------2", "12@3.4.5.6", "a@b..c", "1 2 3", "", "9" * 300]:
        assert disclosure.base_spans(t) == brute(t), t


def test_query_against_plain_search(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_disclosure"](spark, sf).collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip for r in rows) > 0
    for r in rows:
        spans = brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans.startswith(joined)
        assert r.n_email == sum(k == "email" for k, _, _ in spans)


def test_a_word_met_only_with_one_address_is_found(spark, text):
    rows = [(i, f"{text(30)} zorblax writes {text(2)} from zb@mail.example.com {text(20)}") for i in range(6)]
    rows += [(100 + i, f"{text(30)} writes {text(20)} u{i}@mail.example.com {text(9)}") for i in range(60)]
    found = {r.doc_id: r.found for r in disclosure.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i in range(6):
        names = {rows[i][1][s.start:s.end] for s in found[i] if s.kind in ("generalise", "remove")}
        assert "zorblax" in names and "writes" not in names
        cleaned = disclosure.replaced(rows[i][1], found[i])
        assert "zorblax" not in cleaned and "zb@" not in cleaned and "[email]" in cleaned
    assert all({s.kind for s in found[100 + i]} == {"email"} for i in range(60))


def test_copies_are_one_piece_of_evidence(spark, text):
    once = f"{text(30)} quibble zb@mail.example.com {text(20)}"
    rows = [(i, once) for i in range(20)] + [(100 + i, text(40)) for i in range(50)]
    found = disclosure.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert all(len(r.found) == (r.doc_id < 100) for r in found)


def slow_telling(rows):
    """(doc_id, word start, word end) of telling words by plain counting over all documents."""
    import math

    terms = lambda t: {disclosure.term(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t)}
    n_word, seen, uses = {}, {}, []
    for i, t in rows:
        for w in terms(t):
            n_word[w] = n_word.get(w, 0) + 1
        for entity, context, near in disclosure.contexts(t, brute(t)):
            seen[entity, context] = {w for w, _, _ in near}
            uses += [(i, entity, w, a, b) for w, a, b in near]
    n_e, n_te, kind_n, kind_te = {}, {}, {}, {}
    for (e, _), ws in seen.items():
        k = e.split(":")[0]
        n_e[e], kind_n[k] = n_e.get(e, 0) + 1, kind_n.get(k, 0) + 1
        for w in ws:
            n_te[e, w], kind_te[k, w] = n_te.get((e, w), 0) + 1, kind_te.get((k, w), 0) + 1
    out = set()
    for i, e, w, a, b in uses:
        k = e.split(":")[0]
        given = (n_te[e, w] + 2 * kind_te[k, w] / kind_n[k]) / (n_e[e] + 2)
        if math.log(len(rows) * given / n_word[w]) / max(math.log(len(rows) / n_e[e]), 1e-9) >= 0.8:
            out.add((i, a, b))
    return out


def test_method_spans_against_plain_counting(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, s.start, s.end) for r in disclosure.sanitise(docs).collect() for s in r.found if s.kind in ("generalise", "remove")}
    assert got and got == slow_telling([(r.doc_id, r.text or "") for r in docs.collect()])


def test_many_values_in_one_text_take_no_square():
    import time

    text = " ".join(f"word{i} u{i}@m{i}.example.org" for i in range(8000))
    begun = time.process_time()
    assert len(disclosure.contexts(text, disclosure.base_spans(text))) == 8000
    assert time.process_time() - begun < 5


def test_odd_rows(odd):
    rows = disclosure.sanitise(odd).collect()
    assert len(rows) == odd.count() and not any(r.found for r in rows if r.doc_id in (0, 1, 2))
    assert disclosure.sanitise(odd.limit(0)).count() == 0
