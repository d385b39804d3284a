"""Toxicity: a linear-chain conditional random field tags toxic words; documents sum up its marginals.

Words carry hashed features (the folded word and its prefixes and suffixes). Labels of single
words come from the labelled documents: in a toxic document a word is tagged if one of its
features is far commoner in toxic than in other documents. The field (two tags, one weight per
feature, 2 x 2 transitions) is fitted by gradients from forward-backward marginals. A document's
score is a logistic function of the marginals of its words; words with a marginal of ``MARK`` or
more are its offending spans.

Forward-backward runs over fixed blocks of positions, all blocks side by side in numpy: each block's
transfer matrix is built first, blocks are chained, then every block is filled in. A text of any
length costs memory in proportion to its words.

Defined results: null or empty text has no words, no spans and the score of a text without toxic
words; repeated rows give repeated results; documents whose labels disagree are not learnt from;
without labels of both classes every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from matchloom.llm.base import FOLD, WORD, map_batches, ships
from matchloom.llm.quality_trees import labelled

ships(__name__)

BITS = 18
BLOCK = 256
MARK = 0.5
#: Bound on the labelled documents the driver learns from.
MAX_ROWS = 4_000
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def features(word: str) -> list[int]:
    """Hashed features of a word: itself without outer punctuation, its prefixes and its suffix."""
    w = word.translate(FOLD).strip(EDGES) or word
    names = {"=" + w, *("<" + w[:k] for k in range(3, 9) if k < len(w)), ">" + w[-4:]}
    return sorted({zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in names})


@dataclass
class Field:
    """Feature weights for the toxic tag, its bias, transition weights, and the document model."""

    weights: np.ndarray
    bias: float
    transitions: np.ndarray
    document: np.ndarray
    constant: float | None = None


def marginals(emission: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """P(tag = 1) of every position. ``emission``: log-odds of tag 1 of the words of all texts, one
    after another; ``lengths``: words per text; ``transitions``: log weights [from, to]. ``pairs``, if
    given, is filled with the expected number of neighbours with each pair of tags."""
    if not len(emission):
        return np.zeros(0)
    (a00, a01), (a10, a11) = np.exp(transitions - transitions.max())
    blocks = -(-lengths // BLOCK)
    text = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(text)) - (np.cumsum(blocks) - blocks)[text]
    size = np.minimum(BLOCK, lengths[text] - nth * BLOCK)
    order = np.argsort(-size, kind="stable")  # at each step the blocks still running are the first ones
    text, nth, size = text[order], nth[order], size[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.cumsum(blocks) - blocks  # of a text's blocks, in text order
    start = (np.cumsum(lengths) - lengths)[text] + nth * BLOCK
    running = np.searchsorted(-size, -np.arange(BLOCK), side="left")
    odds = np.exp(np.clip(emission, -30, 30))
    e = [odds[start[:k] + t] for t, k in enumerate(running)]
    # What a block makes of the tag before it, as a matrix; only texts of several blocks need it.
    m = [np.ones(len(order)), np.zeros(len(order)), np.zeros(len(order)), np.ones(len(order))]
    deepest = int(blocks.max())
    if deepest > 1:
        for t, k in enumerate(running):
            for x, y in ((0, 1), (2, 3)):
                u, v = m[x][:k], m[y][:k]
                m[x][:k], m[y][:k] = u * a00 + v * a10, (u * a01 + v * a11) * e[t]
            if t % 8 == 7:
                scale = 1 / (m[0][:k] + m[1][:k] + m[2][:k] + m[3][:k])
                for x in m:
                    x[:k] *= scale
    before, after = np.ones(len(order)), np.ones(len(order))  # weight of tag 1 over that of tag 0
    now = np.ones(len(lengths))
    for k in range(deepest - 1):  # over the blocks of a text, all texts at once
        ok = np.flatnonzero(blocks > k + 1)
        at = place[first[ok] + k]
        now[ok] = (m[1][at] + now[ok] * m[3][at]) / (m[0][at] + now[ok] * m[2][at])
        before[place[first[ok] + k + 1]] = now[ok]
    now = np.ones(len(lengths))
    for k in range(deepest - 1, 0, -1):
        ok = np.flatnonzero(blocks > k)
        at = place[first[ok] + k]
        now[ok] = (m[2][at] + m[3][at] * now[ok]) / (m[0][at] + m[1][at] * now[ok])
        after[place[first[ok] + k - 1]] = now[ok]
    forward, r = [], before
    for t, k in enumerate(running):
        r = e[t] * (a01 + a11 * r[:k]) / (a00 + a10 * r[:k])
        forward.append(r)
    out = np.empty(len(emission))
    for t in range(BLOCK - 1, -1, -1):
        k = running[t]
        s = after[:k]
        both = forward[t] * s
        out[start[:k] + t] = both / (1 + both)
        es = e[t] * s
        if pairs is not None:
            q = forward[t - 1][:k] if t else before[:k]
            some = slice(None) if t else nth[:k] > 0
            w = np.stack([np.full(k, a00), a01 * es, q * a10, q * a11 * es])[:, some]
            pairs += (w / w.sum(axis=0)).sum(axis=1).reshape(2, 2)
        after[:k] = (a10 + a11 * es) / (a00 + a01 * es)
    return out


class _Table:
    """Distinct words, numbered, with their features in one flat array."""

    def __init__(self):
        self.number: dict[str, int] = {}

    def ids(self, words: list[str]) -> np.ndarray:
        number = self.number
        return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))

    def flat(self):
        lists = [features(w) for w in self.number]
        return np.concatenate([np.asarray(x, np.int32) for x in lists]), np.repeat(np.arange(len(lists)), [len(x) for x in lists])


def _summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What the document model sees: a constant, the largest marginal, log of their sum, sum per word."""
    out = np.zeros((len(lengths), 4))
    out[:, 0] = 1
    full = np.flatnonzero(lengths)
    if len(full):
        start = (np.cumsum(lengths) - lengths)[full]
        total = np.add.reduceat(np.where(p >= 0.2, p, 0), start)  # else many doubtful words make a long text toxic
        out[full, 1] = np.maximum.reduceat(p, start)
        out[full, 2] = np.log1p(total)
        out[full, 3] = np.minimum(1, 20 * total / lengths[full])
    return out


def fit(texts: list[str], y: np.ndarray, rounds: int = 30, rate: float = 0.5, sure: float = 4.0, least: int = 5) -> Field:
    """The field and the document model from labelled texts."""
    zero = Field(np.zeros(1 << BITS), 0.0, np.zeros((2, 2)), np.zeros(4), float(y.mean()) if len(y) else 0.0)
    if not len(y) or y.min() == y.max():
        return zero
    table = _Table()
    ids = [table.ids(WORD.findall(t)) for t in texts]
    lengths = np.array([len(x) for x in ids])
    if not lengths.sum():
        return zero
    word = np.concatenate(ids)
    feature, owner = table.flat()
    # Documents of each class that hold each feature.
    held = np.zeros((2, 1 << BITS))
    bounds = np.searchsorted(owner, np.arange(len(table.number) + 1))
    for x, label in zip(ids, y):
        own = np.unique(x)
        if len(own):
            got = np.concatenate([feature[bounds[w]:bounds[w + 1]] for w in own])
            held[int(label)][np.unique(got)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()])
    odds = np.log((held[1] + 0.5) / (n[1] + 1)) - np.log((held[0] + 0.5) / (n[0] + 1))
    spread = np.sqrt(1 / (held[1] + 0.5) + 1 / (held[0] + 0.5))
    telling = (held[1] >= least) & (odds / spread >= sure) & (odds >= np.log(8))
    usable = held.sum(axis=0) >= least
    marked = np.zeros(len(table.number), bool)
    marked[owner[telling[feature]]] = True
    target = marked[word] & np.repeat(y == 1, lengths)
    feature_ok = usable[feature]
    feature, owner = feature[feature_ok], owner[feature_ok]
    w, bias, trans = np.zeros(1 << BITS), -4.0, np.array([[0.0, 0.0], [0.0, 0.0]])
    sum_w, sum_b, sum_t = np.full(1 << BITS, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    seen = np.bincount(word, minlength=len(table.number))
    tagged = np.bincount(word[target], minlength=len(table.number))
    joined = np.ones(len(word), bool)
    joined[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    inner = np.flatnonzero(joined)
    pairs_seen = np.zeros((2, 2))
    np.add.at(pairs_seen, (target[inner - 1].astype(int), target[inner].astype(int)), 1)
    for _ in range(rounds):
        per_word = np.bincount(owner, w[feature], len(table.number)) + bias
        expected = np.zeros((2, 2))
        p = marginals(per_word[word], lengths, trans, expected)
        g_word = np.bincount(word, p, len(table.number)) - tagged
        g = np.bincount(feature, g_word[owner], 1 << BITS) + 0.05 * w
        g_b = (p.sum() - target.sum()) / 50
        g_t = (expected - pairs_seen) / 50
        sum_w, sum_b, sum_t = sum_w + g ** 2, sum_b + g_b ** 2, sum_t + g_t ** 2
        w, bias, trans = w - rate * g / np.sqrt(sum_w), bias - rate * g_b / np.sqrt(sum_b), trans - 0.2 * rate * g_t / np.sqrt(sum_t)
    per_word = np.bincount(owner, w[feature], len(table.number)) + bias
    x = _summary(marginals(per_word[word], lengths, trans), lengths)
    beta = np.zeros(4)
    for _ in range(30):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(4), x.T @ (p - y) + 0.5 * beta)
    return Field(w, bias, trans, beta)


def train(docs: DataFrame, labels: DataFrame, learn_from, max_rows: int = MAX_ROWS, **options) -> Field:
    """A field from the labelled documents that ``learn_from`` (a condition on ``doc_id``) admits."""
    rows = labelled(docs, labels, "toxic", learn_from, max_rows).dropDuplicates(["doc_id", "text"]).limit(max_rows)
    table = rows.orderBy("doc_id").toPandas()
    return fit(table["text"].tolist(), table["y"].to_numpy(float), **options)


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, ``score`` and ``found`` (start, end, p of each offending word) of every document."""
    known: dict[str, float] = {}

    def log_odds(word: str) -> float:
        got = known.get(word)
        if got is None:
            if len(known) > 400_000:
                known.clear()
            got = known[word] = float(field.weights[features(word)].sum()) + field.bias
        return got

    def batch(c):
        words = [WORD.findall(t or "") for t in c["text"]]
        lengths = np.array([len(x) for x in words])
        emission = np.fromiter((log_odds(w) for x in words for w in x), np.float64, int(lengths.sum()))
        p = marginals(emission, lengths, field.transitions)
        if field.constant is not None:
            return {"doc_id": c["doc_id"], "score": [field.constant] * len(words), "found": [[] for _ in words]}
        value = 1 / (1 + np.exp(-np.clip(_summary(p, lengths) @ field.document, -30, 30)))
        found, ends = [], np.cumsum(lengths)
        for i, t in enumerate(c["text"]):
            own = p[ends[i] - lengths[i]:ends[i]]
            if len(own) and own.max() >= MARK:
                found.append([{"start": m.start(), "end": m.end(), "p": float(q)}
                              for m, q in zip(WORD.finditer(t), own) if q >= MARK])
            else:
                found.append([])
        return {"doc_id": c["doc_id"], "score": value, "found": found}

    return map_batches(docs.select("doc_id", "text"), batch,
                       "doc_id bigint, score double, found array<struct<start:bigint,end:bigint,p:double>>")
