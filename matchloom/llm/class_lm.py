"""Language-model scoring with Brown classes.

Every counted word has a class of its own. Passes over the training documents, each combined inside its tasks before the shuffle:
word counts; what stands around words; and the classes of all words in their places. A unit is one of the
``OWN`` commonest words, the end mark, or a bucket of other words with the same ending. The exchange
algorithm moves units between classes while the mutual information of neighbouring classes grows. The buckets' classes are only where
their words begin: then each of these words moves, on Spark, by the same exchange, to the class that gains most, judged by
its own neighbours with the classes that units have. All of them move at once and one time. Classes following each other are then counted
anew, with every word in its class. A word has probability P(class | class before) * P(unit | class) * P(word | unit), all smoothed;
the words of a class outside the commonest are one unit.

Counts and classes of the commonest words (``FREQUENT`` at most, a documented bound) travel to the tasks; all other
words of a document are joined with the table of words, so every count and class is exact at any vocabulary. A word that training did not
meet has the class of its ending.

Defined results: null text counts as empty and has one token, the end mark; repeated rows are scored
and counted each; without training documents every count is zero.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import BYTE_FOLD, pieces, ships
from matchloom.session import fresh_dir, materialize, remove

ships(__name__)

OWN = 768
BUCKETS = 255
UNITS = OWN + BUCKETS + 1
END = UNITS - 1
CLASSES = 48
SELF = UNITS  # a neighbour that is the word itself
SIDE = UNITS + 1
CODE, MOST = 21, 2047  # both neighbours in the low bits of an entry, how often in the others
FREQUENT = 200_000
ABSENT = 255
PLACE = 1024  # a place in a text is multiplied by it to hold a class or a bucket as well
FLUSH = 400_000  # distinct words a task holds before it hands its counts on
HELD = 4_000_000  # places of words that a task holds
ADD = 0.1


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(BYTE_FOLD).split()


def bucket(word: bytes) -> int:
    """By the last three characters."""
    return zlib.crc32(word[-3:] if word.isascii() else word.decode()[-3:].encode()) % BUCKETS


def _bucket_sql(word):
    return F.crc32(F.when(F.length(word) > 3, F.substring(word, -3, 3)).otherwise(word).cast("binary")) % BUCKETS


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all documents, without the end marks."""
    def run(batches):
        seen: Counter[bytes] = Counter()

        def out():
            made = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return made

        for batch in (part for whole in batches for part in pieces(whole)):
            for t in batch.column(0).to_pylist():
                seen.update(tokens(t))
            if len(seen) > FLUSH:
                yield out()
        if seen:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(words: list[bytes]) -> defaultdict:
    """Numbers the words it is asked for, the given ones first."""
    number = defaultdict(None, {w: i for i, w in enumerate(words)})
    number.default_factory = number.__len__
    return number


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Pieces of ``data`` up to each of the ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def contexts(docs: DataFrame, units) -> DataFrame:
    """What stands around words, in units: rows without a ``word`` say that unit ``before`` is followed by unit ``after`` ``n`` times
    (a text begins after an end mark); the others have, packed, how often a word that is no unit itself stands between which two."""
    names = ["word", "around", "before", "after", "n"]

    def run(batches):
        own = len(units.value)
        number, held = vocabulary(units.value), []
        unit = np.append(np.arange(own), END)  # the last one is an end mark's
        total = np.zeros(UNITS * UNITS, np.int64)

        def out():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            parts = -(-n // MOST)
            last = np.cumsum(parts) - 1
            times = np.full(int(parts.sum()), MOST, np.int64)
            times[last] = n - (parts - 1) * MOST
            key = np.repeat(key, parts)
            entries = ((times << CODE) | (key & ((1 << CODE) - 1))).astype(np.uint32)
            of_word = key >> CODE
            ends = np.append(np.flatnonzero(np.diff(of_word)) + 1, len(of_word))
            known = list(number)
            words = [known[i].decode() for i in of_word[ends - 1].tolist()]
            held.clear()
            none = pa.nulls(len(words), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), binaries(entries, ends), none, none, none.cast(pa.int64())], names=names)

        for batch in (part for whole in batches for part in pieces(whole)):
            ids = [-1]
            for t in batch.column(0).to_pylist():
                ids.extend(map(number.__getitem__, tokens(t)))
                ids.append(-1)
            new = [OWN + bucket(w) for w in islice(number, len(unit) - 1, None)]
            unit = np.concatenate([unit[:-1], np.array(new, np.int64), unit[-1:]])
            at = np.array(ids, np.int64)
            u = unit[at]
            total += np.bincount(u[:-1] * UNITS + u[1:], minlength=len(total))
            inner = np.flatnonzero(at[1:-1] >= own) + 1
            if len(inner):
                word = at[inner]
                before, after = (np.where(at[inner + d] == word, SELF, u[inner + d]) for d in (-1, 1))
                held.append((word << CODE) | (before * SIDE + after))
            if held and (len(number) > FLUSH or sum(map(len, held)) > HELD):
                yield out()
                number, unit = vocabulary(units.value), unit[[*range(own), -1]]
        if held:
            yield out()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(some), pa.string()), pa.nulls(len(some), pa.binary()), pa.array((some // UNITS).astype(np.int32)),
             pa.array((some % UNITS).astype(np.int32)), pa.array(total[some])], names=names)

    return docs.select("text").mapInArrow(run, "word string, around binary, before int, after int, n bigint")


def exchange(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each unit: units move, one at a time, to the class with the largest average
    mutual information of neighbours, until a sweep moves none."""
    n = len(pairs)
    classes = min(classes, n)
    order = np.argsort(-(pairs.sum(axis=0) + pairs.sum(axis=1)), kind="stable")
    of = np.empty(n, np.int64)
    of[order] = np.arange(n) % classes
    member = np.eye(classes)[of]
    table = member.T @ pairs @ member
    f, moved = _entropy, 1
    while moved:
        moved = 0
        for u in order:
            a = of[u]
            self_ = pairs[u, u]
            out = np.bincount(of, pairs[u], classes)
            into = np.bincount(of, pairs[:, u], classes)
            out[a] -= self_
            into[a] -= self_
            table[a] -= out
            table[:, a] -= into
            table[a, a] -= self_
            left, right = table.sum(axis=1) + into, table.sum(axis=0) + out
            rows = (f(table + out) - f(table)).sum(axis=1)
            cols = (f(table + into[:, None]) - f(table)).sum(axis=0)
            d = np.diag(table)
            corner = f(d + out + into + self_) - f(d + out) - f(d + into) + f(d)
            # Totals grow for the class joined only; its neighbours get theirs back whatever the choice.
            gain = rows + cols + corner - (f(left + out.sum() + self_) - f(left)) - (f(right + into.sum() + self_) - f(right))
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            of[u] = b
            table[b] += out
            table[:, b] += into
            table[b, b] += self_
    return of


def _entropy(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def best_classes(table: np.ndarray, of: np.ndarray, after: tuple, before: tuple, self_: np.ndarray) -> np.ndarray:
    """The class each word moves to from ``of`` by the exchange's gain, other words staying. ``table`` counts classes following
    each other; ``after`` and ``before`` are (word, class, n), each pair once, by word, of neighbours other than the word itself."""
    f, k, words = _entropy, len(table), np.arange(len(of))
    known = f(table.astype(float))
    out, into = np.zeros((len(of), k)), np.zeros((len(of), k))
    out[after[0], after[1]], into[before[0], before[1]] = after[2], before[2]
    gain = np.zeros((len(of), k))
    for (word, c, n), own, other, cells, logs in ((after, out, into, table.T, known.T), (before, into, out, table, known)):
        for low in range(0, len(word), 20_000):
            w, at, m = word[low:low + 20_000], c[low:low + 20_000], n[low:low + 20_000]
            held, held_f, all_ = cells[at].astype(float), logs[at], np.arange(len(w))  # of every class beside the neighbour's, without the word itself
            held[all_, of[w]] -= own[w, at]
            same = np.flatnonzero(at == of[w])
            held[same] -= other[w[same]]
            held[same, of[w[same]]] -= self_[w[same]]
            held_f[all_, of[w]] = f(held[all_, of[w]])
            held_f[same] = f(held[same])
            more, starts = f(held + m[:, None]) - held_f, np.flatnonzero(np.diff(w, prepend=-1))
            gain[w[starts]] += np.add.reduceat(more, starts)
    d = np.tile(np.diag(table).astype(float), (len(of), 1))
    d[words, of] -= out[words, of] + into[words, of] + self_
    s = self_[:, None]
    gain += f(d + out + into + s) - f(d + out) - f(d + into) + f(d)
    for total, mine in ((table.sum(axis=1), out), (table.sum(axis=0), into)):
        moved = mine.sum(axis=1, keepdims=True) + s
        rest = np.tile(total.astype(float), (len(of), 1))
        rest[words, of] -= moved[:, 0]
        gain -= f(rest + moved) - f(rest)
    b = gain.argmax(axis=1)
    return np.where(gain[words, b] <= gain[words, of] + 1e-9, of, b)


def word_classes(around: DataFrame, classes: np.ndarray, table: np.ndarray) -> DataFrame:
    """``word``, ``n`` and ``class`` of the words that are no units, moved from their buckets' classes."""
    shared = around.sparkSession.sparkContext.broadcast((classes, table))

    def pairs(word, c, n, keep):
        """Sums of n by (word, class), of neighbours to keep."""
        code, at = np.unique(word[keep] * CLASSES + c[keep], return_inverse=True)
        return code // CLASSES, code % CLASSES, np.bincount(at, n[keep], len(code))

    def run(batches):
        classes, table = shared.value
        of_neighbour = np.append(classes, CLASSES)
        for batch in batches:
            names, held = batch.column(0), batch.column(1)
            packed = pa.concat_arrays([held.flatten()])
            entries = np.frombuffer(packed.buffers()[2], np.uint32, count=pc.sum(pc.binary_length(packed)).as_py() // 4).astype(np.int64)
            word = np.repeat(np.repeat(np.arange(len(names)), held.value_lengths().to_numpy()), pc.binary_length(packed).to_numpy() // 4)
            n, code = entries >> CODE, entries & ((1 << CODE) - 1)
            before, after = of_neighbour[code // SIDE], of_neighbour[code % SIDE]
            of = np.array([classes[OWN + bucket(w.encode())] for w in names.to_pylist()], np.int64)
            counts = np.bincount(word, n, len(names)).astype(np.int64)
            # Words met once with the same neighbours and beginnings move alike: each kind of them is judged once.
            once = counts[word] == 1
            kind = np.arange(len(names))
            kind[word[once]] = len(names) + (of[word[once]] * (CLASSES + 1) + before[once]) * (CLASSES + 1) + after[once]
            _, first, to = np.unique(kind, return_index=True, return_inverse=True)
            place = np.full(len(names), -1)
            place[first] = np.arange(len(first))
            some = place[word] >= 0
            at = place[word[some]]
            b, a, m = before[some], after[some], n[some].astype(float)
            moved = best_classes(
                table, of[first], pairs(at, a, m, a < CLASSES), pairs(at, b, m, b < CLASSES), np.bincount(at, m * (a == CLASSES), len(first)))
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(counts), pa.array(moved[to].astype(np.int32))], names=["word", "n", "class"])

    single = around.filter("word IS NOT NULL").select("word", "around").repartition("word")
    return single.groupBy("word").agg(F.collect_list("around").alias("around")).mapInArrow(run, "word string, n bigint, class int")


@dataclass
class Model:
    """What scoring needs besides the counts and classes of infrequent words. The units of a model are its commonest words, what else
    each class holds, and the end mark."""

    words: list[bytes]  # frequent words, the units' own first
    counts: np.ndarray
    word_class: np.ndarray
    bucket_class: np.ndarray  # of words that training did not meet
    own: int
    n: int  # training tokens, ends included
    v: int
    ends: int
    classes: np.ndarray
    log_step: np.ndarray  # log10 P(class | class before)
    log_unit: np.ndarray  # log10 P(unit | class)
    log_room: np.ndarray  # log10 of the denominator of P(word | unit), per class


def sequences(docs: DataFrame, model: Model, counts: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, the class of each token in its place (``ABSENT``: not of the model's words), what words give to ``known`` and ``base``, what
    the model's words give to ``own`` (log10 of the probability in the class), and of the other words ``found``, place and class in one number, and ``log_n``."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(replace(model, log_step=None)))  # plain values: workers need no copy of this module

    def run(batches):
        m = shared.value
        words, size = m["words"], len(m["words"])
        unit = np.where(np.arange(size) < m["own"], np.arange(size), OWN + m["word_class"][:size])
        unit = np.append(unit, OWN + CLASSES)
        log_c = np.log10(np.append(m["counts"], m["ends"]) + ADD)
        rest = (unit >= OWN) & (unit < OWN + CLASSES)
        own = m["log_unit"][unit] + np.where(rest, log_c - m["log_room"][np.clip(unit - OWN, 0, CLASSES - 1)], 0)
        # By number of a word; then an end mark, then a word elsewhere.
        of, log_c, own = np.append(m["classes"][unit], ABSENT).astype(np.uint8), np.append(log_c, 0), np.append(own, 0)
        is_known = np.append(np.ones(size, np.int64), [m["ends"] > 0, 0])
        number, names = vocabulary(words), []
        for batch in (part for whole in batches for part in pieces(whole)):
            ids, ends = [], []
            for t in batch.column(2).to_pylist():
                ids.extend(map(number.__getitem__, tokens(t)))
                ids.append(-1)
                ends.append(len(ids))
            new = list(islice(number, size + len(names), None))
            names += [w.decode() for w in new]
            at, ends = np.array(ids, np.int64), np.array(ends, np.int64)
            first = np.append(0, ends[:-1])
            rare = np.flatnonzero(at >= size)
            which, at[at < 0] = at[rare] - size, size
            at[rare] = size + 1
            text = np.searchsorted(ends, rare, side="right")
            found = pa.StructArray.from_arrays(
                [pa.array((rare - first[text]).astype(np.int32)), pa.array(names, pa.string()).take(pa.array(which))], names=["at", "word"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.searchsorted(rare, ends)).astype(np.int32)), found)
            sums = [pa.array(np.add.reduceat(x[at], first)) for x in (is_known, log_c, own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ends - first), *sums, binaries(of[at], ends), lists],
                names=["key", "doc_id", "n_tokens", "known", "base", "own", "classes", "rare"])
            if len(names) > FLUSH:
                number, names = vocabulary(words), []

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    path = path or fresh_dir(docs.sparkSession, "places")
    keyed.mapInArrow(
        run, "key bigint, doc_id bigint, n_tokens bigint, known bigint, base double, own double, classes binary, "
        "rare array<struct<at:int,word:string>>").write.parquet(path)
    part = docs.sparkSession.read.parquet(path)
    joined = part.select("key", F.explode("rare").alias("r")).select("key", "r.*").join(counts, "word", "left")
    # A class, or what a word that training did not meet begins with: its bucket.
    of = F.coalesce(F.col("class"), CLASSES + _bucket_sql(F.col("word")))
    narrow = joined.select("key", (F.col("at").cast("bigint") * PLACE + of).alias("place"), F.coalesce("n", F.lit(0)).alias("n")).repartition("key")
    found = narrow.groupBy("key").agg(
        F.collect_list("place").alias("found"), F.sum(F.log10(F.col("n") + ADD)).alias("log_n"), F.count_if(F.col("n") > 0).alias("met"))
    return part.drop("rare").join(found, "key", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("met", F.lit(0))).alias("known"),
        (F.col("base") + F.coalesce("log_n", F.lit(0.0))).alias("base"), "own", "classes", "found", F.coalesce("log_n", F.lit(0.0)).alias("log_n"))


def _whole(batch: pa.RecordBatch, bucket_class: np.ndarray):
    """Of a batch of ``sequences``: where texts begin, the classes of all tokens, and of the words that were elsewhere the text and class."""
    first = np.cumsum(batch.column(1).to_numpy()) - batch.column(1).to_numpy()
    classes = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).astype(np.int64)
    place = batch.column(6).flatten().to_numpy()
    text = np.repeat(np.arange(len(first)), batch.column(6).value_lengths().fill_null(0).to_numpy())
    of = np.append(np.arange(CLASSES), bucket_class)[place % PLACE]
    classes[first[text] + place // PLACE] = of
    return first, classes, text, of


def class_steps(texts: DataFrame, model: Model) -> np.ndarray:
    """How often each class follows each in ``sequences``."""
    shared = texts.sparkSession.sparkContext.broadcast((model.bucket_class, int(model.classes[-1])))

    def run(batches):
        of_bucket, end = shared.value
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in (part for whole in batches for part in pieces(whole)):
            first, classes, *_ = _whole(batch, of_bucket)
            before = np.empty_like(classes)
            before[1:] = classes[:-1]
            before[first] = end
            total += np.bincount(before * CLASSES + classes, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["step", "n"])

    steps = np.zeros(CLASSES * CLASSES)
    for r in texts.mapInArrow(run, "step int, n bigint").groupBy("step").agg(F.sum("n")).collect():
        steps[r[0]] = r[1]
    return steps.reshape(CLASSES, CLASSES)


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the given documents, and the table of all words with their counts and classes."""
    spark = docs.sparkSession
    counts = materialize(word_counts(docs), "word-counts")
    ends = docs.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The commonest words: a threshold on the count that at most FREQUENT words reach.
    scale = F.floor(F.log2("n") * 16)
    bins = sorted(((r[0], r[1]) for r in counts.groupBy(scale.alias("b")).count().collect()), reverse=True)
    reached, least = 0, None
    for b, k in bins:
        if reached + k > FREQUENT:
            break
        reached, least = reached + k, b

    def frequent(table: DataFrame):
        some = table.filter(scale >= least) if least is not None else table.limit(0)
        return some.toPandas().sort_values(["n", "word"], ascending=[False, True])

    top = frequent(counts)[:OWN]
    own = len(top)
    units = spark.sparkContext.broadcast([w.encode() for w in top["word"]])
    path = fresh_dir(spark, "contexts")
    contexts(docs, units).write.parquet(path)
    around = spark.read.parquet(path)
    met = around.filter("word IS NULL").groupBy("before", "after").agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros((UNITS, UNITS))
    pairs[met["before"], met["after"]] = met["n"]
    of = exchange(pairs)
    member = np.eye(CLASSES)[of]
    moved = materialize(word_classes(around, of, member.T @ pairs @ member), "word-classes")
    remove(spark, path)
    # Other words of each class: tokens and distinct words.
    room = np.zeros((2, CLASSES))
    for r in moved.groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        room[:, r[0]] = r[1], r[2]
    commonest = [(w, int(n), int(c)) for w, n, c in zip(top["word"], top["n"], of)]
    classed = moved.unionByName(spark.createDataFrame(commonest, "word string, n bigint, class int"))
    held = frequent(classed)
    words, word_class = [w.encode() for w in held["word"]], held["class"].to_numpy(np.int64)
    bucket_class = of[OWN:OWN + BUCKETS]
    classes = np.concatenate([of[:OWN], np.arange(CLASSES), of[END:]])
    member = np.eye(CLASSES)[classes]
    unit_n = np.concatenate([pairs.sum(axis=0)[:OWN], room[0], [ends]])
    class_n = member.T @ unit_n
    prior = (class_n + 0.5) / (class_n.sum() + 0.5 * CLASSES)
    unit = (unit_n + ADD) / (class_n + ADD * member.sum(axis=0))[classes]
    model = Model(words, held["n"].to_numpy(np.int64), word_class, bucket_class, own, int(total[0]) + ends, int(total[1]) + (ends > 0), ends, classes,
                  np.log10(prior), np.log10(unit), np.log10(room[0] + ADD * (room[1] + 1)))
    path = fresh_dir(spark, "places")
    smooth, steps = 5.0, class_steps(sequences(docs, model, classed, path), model)
    remove(spark, path)
    step = (steps + smooth * prior) / (steps.sum(axis=1, keepdims=True) + smooth)
    return replace(model, log_step=np.log10(step)), classed


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 probabilities) of every row."""
    plain = {k: v for k, v in vars(model).items() if k not in ("words", "counts", "word_class")}
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def run(batches):
        m = shared.value
        for batch in (part for whole in batches for part in pieces(whole)):
            first, classes, text, of = _whole(batch, m["bucket_class"])
            lengths, known, base, own = (batch.column(i).to_numpy() for i in range(1, 5))
            before = np.empty_like(classes)
            before[1:] = classes[:-1]
            before[first] = m["classes"][-1]
            rest = np.bincount(text, (m["log_unit"][OWN + np.arange(CLASSES)] - m["log_room"])[of], len(first)) + batch.column(7).to_numpy()
            steps = np.add.reduceat(m["log_step"][before, classes], first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths), pa.array(known), pa.array(base - lengths * np.log10(m["n"] + ADD * (m["v"] + 1))),
                 pa.array(steps + own + rest)],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return sequences(docs, model, counts).mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
