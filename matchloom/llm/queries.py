"""The registered queries of this folder: each applies its operator, with production parameters,
to the whole of its table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom.llm import auction_repair, bpe, class_lm, disclosure, gray_index, host_rules, mixing, quality_trees, spaced_seeds, term_pointers, toxic_spans, trigrams, winnow
from matchloom.llm.base import LOWER, UPPER, remainder
from matchloom.session import load

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _digests(found, kinds: list[str]):
    """Counts per base kind, the digest of the base spans and all spans."""
    spans = F.col("found")
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id", *[_count(spans, k).alias(f"n_{k}") for k in kinds],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


@query
def op1_quality_trees(spark, sf):
    docs = load(spark, sf, "documents")
    trees = quality_trees.train(docs, load(spark, sf, "labels"), remainder(3) != 1)
    return quality_trees.score(docs, trees).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_host_rules(spark, sf):
    return host_rules.judge(load(spark, sf, "documents")).withColumn("failed", F.array_join("failed", ","))


@query
def op3_disclosure(spark, sf):
    return _digests(disclosure.sanitise(load(spark, sf, "documents")), disclosure.KINDS)


@query
def op4_winnowed_lines(spark, sf):
    docs = winnow.dedup(load(spark, sf, "documents").select("doc_id", "text"), report=True)
    return docs.select("doc_id", "cut", F.array_join(F.transform("removed", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("removed"), "text")


TARGETS = {"good": 0.92, "poor": 0.05, "toxic": 0.03}


@query
def op5_soft_mixing(spark, sf):
    mixed = mixing.mix(load(spark, sf, "documents"), mixing.domain_labels(load(spark, sf, "labels")), TARGETS)
    return mixed.select("doc_id", "tokens", *[F.get("p", i).alias(f"p_{d}") for i, d in enumerate(TARGETS)], "rate")


@query
def op6_trigram_secrets(spark, sf):
    return _digests(trigrams.scan(load(spark, sf, "documents")), [k for k, _, _ in trigrams.BASE_RULES])


@query
def op8_toxic_field(spark, sf):
    docs = load(spark, sf, "documents")
    field = toxic_spans.train(docs, load(spark, sf, "labels"), remainder(4) != 2)
    return toxic_spans.score(docs, field).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
        .alias("spans"))


@query
def op9_gray_simhash(spark, sf):
    return gray_index.near_duplicates(load(spark, sf, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_class_lm(spark, sf):
    docs = load(spark, sf, "documents")
    model, counts = class_lm.train(docs.filter(remainder(10) != 0))
    return class_lm.score(docs, model, counts).select(
        "doc_id", (remainder(10) == 0).alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"),
        "base_score", "score")


@query
def op7_spaced_seeds(spark, sf):
    return spaced_seeds.overlaps(load(spark, sf, "documents"), load(spark, sf, "benchmark")).drop("h")


@query
def op11_term_divergence(spark, sf):
    return term_pointers.audit(load(spark, sf, "documents"))


@query
def op12_backtracking_bpe(spark, sf):
    import public_tokenizers

    return bpe.encode(load(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests=True)


@query
def op13_auction_repair(spark, sf):
    return auction_repair.repair(load(spark, sf, "conversations"))


_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_FAILS = "CASE WHEN {rule} THEN 1.0 ELSE 0.0 END"


def _host_rules_sql() -> str:
    rules = {"base_failed": "base_failed", **{r: f"({c})" for r, c in host_rules.RULES.items()}}
    sums = ", ".join(f"sum({_FAILS.format(rule=c)}) AS f_{r}" for r, c in rules.items())
    whole = ", ".join(
        f"sum(f_{r}) / sum(n) AS m_{r}, avg((f_{r} / n) ** 2) - avg(f_{r} / n) ** 2 - (sum(f_{r}) / sum(n)) * (1 - sum(f_{r}) / sum(n)) * avg(1.0 / n) AS v_{r}"
        for r in rules)
    strength = ", ".join(
        f"m_{r}, CASE WHEN v_{r} > 0 THEN least(10000.0, greatest(1.0, m_{r} * (1 - m_{r}) / v_{r} - 1)) ELSE 10000.0 END AS s_{r}" for r in rules)
    rates = ", ".join(f"(f_{r} + m_{r} * s_{r}) / (n + s_{r}) >= 0.5 AS h_{r}" for r in rules)
    failed = ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in rules.items() if r != "base_failed")
    by_host = " OR ".join(f"({c} AND h_{r})" for r, c in rules.items() if r != "base_failed")
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, {_WORDS.format(text='t')} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM dup) GROUP BY 1),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, {sums} FROM j GROUP BY source),
a AS (SELECT {whole} FROM h),
s AS (SELECT {strength} FROM a),
v AS (SELECT source, {rates} FROM h, s)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, h_base_failed AS host_rejected,
  array_to_string(list_filter([{failed}], lambda x: x IS NOT NULL), ',') AS failed, NOT base_failed AND NOT h_base_failed AND NOT ({by_host}) AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
"""


def _spaced_seeds_sql() -> str:
    drop, keep = (UPPER + spaced_seeds.PUNCTUATION).replace("'", "''"), LOWER
    words = _WORDS.format(text=f"translate(coalesce(text, ''), '{drop}', '{keep}')")
    return f"""
WITH d AS (SELECT doc_id, {words} AS ws FROM documents), b AS (SELECT item_id, {words} AS ws FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
bw AS (SELECT item_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM b WHERE len(ws) >= {spaced_seeds.SPAN}),
o AS (SELECT doc_id, item_id, dw.p - bw.p AS start, any_value(n) AS item_words, count(*) AS matched FROM dw JOIN bw USING (w) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, start) AS r FROM o WHERE matched >= 0.8 * item_words)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(matched AS INTEGER) AS matched, CAST(item_words AS INTEGER) AS item_words,
  matched / item_words AS similarity FROM k WHERE r = 1
"""


def _term_divergence_sql() -> str:
    p = f"1 + CAST({term_pointers.SCALE} AS HUGEINT) * ({{c}} + 1) // ({{n}} + v)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT i, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{UPPER}', '{LOWER}') AS term FROM d),
k AS (SELECT lang, term, count(*) AS lc FROM w GROUP BY 1, 2 HAVING count(DISTINCT i) >= {term_pointers.LEAST_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(lc) AS ln FROM k GROUP BY 1),
c AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT lang, source, coalesce(any_value(n), 0) AS n, coalesce(any_value(v), 0) AS v, coalesce(any_value(ln), 0) AS ln
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY 1, 2) USING (lang, source) LEFT JOIN l USING (lang) GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, {p.format(c='coalesce(c.c, 0)', n='g.n')} AS p, {p.format(c='k.lc', n='g.ln')} AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM o WHERE part = 'pair' OR r <= {term_pointers.TOP}
"""


def _auction_repair_sql() -> str:
    """Conversations from the last row to the first: for each state the least text of cost, letters and repaired lines to the end."""
    after = {0: {"u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    name = {"u": "user", "a": "assistant"}

    def more(value: str, cost: str, letter: str, line: str) -> str:
        # nine digits of cost, the letters, chr(1), the lines
        return (f"(lpad(CAST(CAST(substr({value}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr(split_part({value}, chr(1), 1), 10)"
                f" || chr(1) || {line} || substr({value}, length(split_part({value}, chr(1), 1)) + 2))")

    def inserted(column: str) -> str:
        out = []
        for q in range(4):
            options = [f"{column}{q}"]
            for r, x in after[q].items():
                options.append(more(f"{column}{x}", "5", "I", f"'{name[r]}:' || chr(10)"))
                for r2, x2 in after[x].items():
                    if x2 != q and x2 != x:
                        options.append(more(f"{column}{x2}", "10", "II", f"'{name[r]}:' || chr(10) || '{name[r2]}:' || chr(10)"))
            out.append(f"least({', '.join(options)}) AS v{q}")
        return ", ".join(out)

    def read(q: int) -> str:
        # Reroled rows get the only role that may follow; a kept row moves by its initial.
        (r, x), = after[q].items()
        keep = {**{i: y for i, y in after[q].items()}, **({"s": 1} if q == 0 else {})}
        kept = " ".join(f"WHEN n.ini = '{i}' THEN {more(f'v{y}', 'n.extra', 'K', 'n.role || chr(58) || n.text || chr(10)')}" for i, y in keep.items())
        alone = more(f"v{q}", "n.extra", "K", "n.role || chr(58) || n.text || chr(10)")
        rerole = more(f"v{x}", "1 + n.extra", "R", f"'{name[r]}:' || n.text || chr(10)")
        delete = more(f"v{q}", "2", "D", "''")
        return f"least({delete}, CASE WHEN NOT n.must THEN {rerole} END, CASE WHEN n.must THEN NULL {kept} WHEN n.ini = '' THEN {alone} END) AS w{q}"

    blank = r"[^\x20\x09-\x0D]"
    # An end that is not allowed costs more than any repair.
    ends = ", ".join(f"'{'000000000' if q in (0, 3) else '900000000'}' || chr(1) AS w{q}" for q in range(4))
    return rf"""
WITH RECURSIVE bits AS (SELECT i, 0 AS k, CAST(i AS BIGINT) AS x FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END FROM bits WHERE k < 8),
tab AS (SELECT list(x ORDER BY i) AS t FROM bits WHERE k = 8),
c0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS codes FROM conversations),
c1 AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, codes), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS kind FROM c0, tab),
c2 AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c1 WHERE kind <> 0),
c3 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, substr(role, 1, 1) AS ini FROM c2),
c4 AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair,
  max(i) OVER (PARTITION BY conv_id) AS rows FROM c3),
c5 AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{blank}') THEN 'b' WHEN again THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE 'k' END AS fault FROM c4),
n AS (SELECT *, fault IN ('b', 'd') AS must, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS extra FROM c5),
s AS (SELECT conv_id, rows AS i, {inserted('w')} FROM (SELECT conv_id, any_value(rows) AS rows, {ends} FROM n GROUP BY conv_id)
  UNION ALL SELECT conv_id, i, {inserted('w')} FROM (SELECT n.conv_id, n.i - 1 AS i, {', '.join(read(q) for q in range(4))} FROM s JOIN n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND s.i = n.i)),
r AS (SELECT conv_id, v0 FROM s WHERE i = 0),
t AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM n GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(CAST(substr(v0, 1, 9) AS BIGINT), 0) AS BIGINT) AS cost, coalesce(substr(split_part(v0, chr(1), 1), 10), '') AS audit,
  sha256(coalesce(regexp_replace(substr(v0, length(split_part(v0, chr(1), 1)) + 2), '\n$', ''), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN t ON o.conv_id IS NOT DISTINCT FROM t.conv_id LEFT JOIN r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
"""


SQL["op11_term_divergence"] = _term_divergence_sql()
SQL["op13_auction_repair"] = _auction_repair_sql()
SQL["op2_host_rules"] = _host_rules_sql()
SQL["op7_spaced_seeds"] = _spaced_seeds_sql()
