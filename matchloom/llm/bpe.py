"""Byte-level BPE by backtracking over longest matches, and decoding through an offset table.

An encoder never replays merges. An Aho-Corasick automaton over the bytes of all tokens gives the longest token from
each place of a piece. Tokens are laid one behind the other; a token may follow another only if the merges would not have
joined bytes across the seam, which the pair-compatibility table answers: it undoes both tokens' last merges step by step
and looks for a merge over the seam that would have come first; answers are kept. A token that does not fit gives way to its
longest prefix that is a token; where none fits, the place is marked dead and the token before it gives way. Every place dies
at most once, so the time is linear in the piece, and what is left is exactly the merges' result.

The vocabulary file (its path is a parameter, nothing of it is kept here) is read once by the driver; its
tables, of the size of the vocabulary, go along with the tasks. Pieces of text that recur are looked up, in a table that is emptied at
``KEPT`` entries. Decoding gathers bytes from one buffer of all tokens by a table of offsets.

Defined results: null and empty texts have no tokens and decode to the empty text; strings of added tokens are those tokens, as the
file says; very long texts and pieces are encoded whole; repeated rows give repeated results; a null ``doc_id`` is
kept; other columns are ignored; an empty table gives no rows. Files with other normalizers, pre-tokenizers or
model options are refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.base import map_batches, ships

ships(__name__)

KEPT = 1 << 18  # pieces of text, and pairs of tokens, whose result is kept by a task
BLOCK = 1 << 16  # ids decoded at once

# How the byte-level pre-tokenizer splits a text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Ranges of code points that the files' library (Unicode 16) takes as unassigned, and the pattern library as letters or numbers.
LATE = (
    "\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    "\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB"
    "\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3"
    "\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191"
    "\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96"
    "\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4"
    "\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such files: printable ones for themselves, the rest counted on from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """What a file says, as plain tables: bytes of every id, the two halves and the order of every merge, added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model, pre, after = said["model"], said["pre_tokenizer"] or {}, said["decoder"] or {}
        kinds = (said["normalizer"], model["type"], pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True), after.get("type"))
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [t["content"] for t in said["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        if kinds != (None, "BPE", "ByteLevel", False, True, "ByteLevel") or odd:
            raise ValueError(f"{path} is not a plain byte-level BPE file: {kinds}, {odd}")
        letters = byte_letters()
        size = 1 + max([*model["vocab"].values(), *(t["id"] for t in said["added_tokens"])])
        self.text = [b""] * size
        for token, i in model["vocab"].items():
            self.text[i] = bytes(map(letters.__getitem__, token))
        self.single = [model["vocab"].get(letter, -1) for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        if -1 in self.single:
            raise ValueError(f"{path} lacks a token of one byte")
        self.left, self.right = list(range(size)), list(range(size))
        self.order = [-1] * size  # of merges; single bytes come before all
        self.joined: dict[tuple[int, int], int] = {}
        for n, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (model["vocab"][a], model["vocab"][b]), model["vocab"][a + b]
            self.joined.setdefault(pair, whole)
            if self.order[whole] < 0:
                self.left[whole], self.right[whole], self.order[whole] = *pair, n
        self.added = {t["content"]: t["id"] for t in said["added_tokens"]}
        for content, i in self.added.items():
            self.text[i] = content.encode()


class Encoder:
    """The automaton and the tables, built where they are used."""

    def __init__(self, v: Vocabulary):
        import ahocorasick

        self.v, self.pairs, self.kept = v, {}, {}
        special = set(v.added.values())
        whole = self._whole(special)
        known = {v.text[i].decode("latin-1"): i for i in whole}
        self.longest = ahocorasick.Automaton()
        self.shorter, self.size = [-1] * len(v.text), [len(t) for t in v.text]
        for text, i in known.items():
            self.longest.add_word(text, i)
            self.shorter[i] = next((known[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in known), -1)
        self.longest.make_automaton()
        self.cut = regex.compile(PIECES)
        self.careful = regex.compile(PIECES.replace(r"\p{L}+", f"[\\p{{L}}--[{LATE}]]+").replace(r"\p{N}+", f"[\\p{{N}}--[{LATE}]]+")
                                     .replace(r"[^\s\p{L}\p{N}]", f"[[^\\s\\p{{L}}\\p{{N}}]||[{LATE}]]"), regex.V1)
        self.high, self.late = re.compile("[\u0558-\U0010FFFF]"), re.compile(f"[{LATE}]")
        self.specials = regex.compile("|".join(map(regex.escape, sorted(v.added, key=len, reverse=True)))) if v.added else None

    def _whole(self, special: set[int]) -> list[int]:
        """Tokens that their own bytes are merged to; the others never come out of the merges."""
        v = self.v
        good = [False] * len(v.text)
        for i in v.single:
            good[i] = True
        for i in sorted((i for i, n in enumerate(v.order) if n >= 0 and i not in special), key=v.order.__getitem__):
            good[i] = good[v.left[i]] and good[v.right[i]] and self._apart(v.left[i], v.right[i], v.order[i])
        return [i for i, ok in enumerate(good) if ok]

    def _apart(self, a: int, b: int, before: int = 1 << 60) -> bool:
        """Whether no merge of an order under ``before`` joins bytes over the seam of the tokens ``a`` and ``b``. Both are undone, the
        later merge first: while one stands whole, only merges that come before its own could have met its seam."""
        v = self.v
        while True:
            over = v.joined.get((a, b))
            if over is not None and v.order[over] < before:
                return False
            x, y = v.order[a], v.order[b]
            if x < 0 and y < 0:
                return True
            # The left token's merge is made first of equals, so the right one is undone first and may still be met by it.
            if x > y:
                before, a = min(before, x), v.right[a]
            else:
                before, b = min(before, y + 1), v.left[b]

    def fits(self, a: int, b: int) -> bool:
        known = self.pairs[a << 32 | b] = self._apart(a, b)
        return known

    def piece(self, text: str) -> list[int]:
        """The ids of one piece, given as a letter per byte."""
        pairs, n, size, shorter = self.pairs, len(text), self.size, self.shorter
        if len(pairs) >= KEPT:
            pairs.clear()
        out = [token for _, token in self.longest.iter_long(text)]  # the longest token, and from its end on again
        last = out[0]
        for token in out[1:]:
            known = pairs.get(last << 32 | token)
            if not (self.fits(last, token) if known is None else known):
                break
            last = token
        else:
            return out
        at = [-1] * n
        for end, token in self.longest.iter(text):
            at[end + 1 - size[token]] = token  # later ends are longer
        alive, out, place, token = bytearray(b"\x01") * (n + 1), [], 0, at[0]
        while place < n:
            end = place + size[token]
            fits = alive[end]
            if fits and out:
                fits = pairs.get(out[-1] << 32 | token)
                if fits is None:
                    fits = self.fits(out[-1], token)
            if fits:
                out.append(token)
                place = end
                token = at[end] if end < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # the token before gives way: it is tried again, and its end is dead now
                alive[place] = 0
                token = out.pop()
                place -= size[token]
        return out

    def plain(self, text: str) -> list[int]:
        """The ids of a text without added tokens."""
        kept = self.kept
        careful = self.high.search(text) is not None and self.late.search(text) is not None
        pieces = (self.careful if careful else self.cut).findall(text)
        if len(kept) >= KEPT:
            kept.clear()
        long = []
        for piece in set(pieces).difference(kept):
            kept[piece] = self.piece(piece.encode().decode("latin-1"))
            if len(piece) > 64:
                long.append(piece)
        out = list(chain.from_iterable(map(kept.__getitem__, pieces)))
        for piece in long:
            del kept[piece]
        return out

    def encode(self, text: str) -> list[int]:
        if self.specials is None:
            return self.plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += self.plain(text[at:m.start()])
            out.append(self.v.added[m[0]])
            at = m.end()
        return out + self.plain(text[at:]) if out else self.plain(text)


class Decoder:
    """One buffer of all tokens' bytes, and where each starts."""

    def __init__(self, texts: list[bytes]):
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.r_[0, np.cumsum([len(t) for t in texts])]

    def blocks(self, ids: np.ndarray) -> Iterator[bytes]:
        for i in range(0, len(ids), BLOCK):
            part = ids[i:i + BLOCK]
            start = self.offsets[part]
            sizes = self.offsets[part + 1] - start
            ends = np.cumsum(sizes)
            yield self.bytes[np.repeat(start - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Bytes that are no UTF-8 become replacement characters."""
        return b"".join(self.blocks(ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of every text; with ``digests`` instead of the ids their number ``n_tokens``, ``ids_sha256`` (of little-endian unsigned
    32-bit integers) and ``decoded_sha256`` (of the decoded text), so that long rows stay where they are."""
    v, made = Vocabulary(path), []

    def tools():
        if not made:
            made.extend((Encoder(v), Decoder(v.text)))
        return made

    def batch(c):
        encoder, decoder = tools()
        out = {"doc_id": c["doc_id"], "ids": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in c["text"]:
            ids = encoder.encode(text)
            if digests:
                coded = np.array(ids, "<u4")
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(coded.tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoder.decode(coded.astype(np.int64)).encode()).hexdigest())
            else:
                out["ids"].append(ids)
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return map_batches(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), batch, f"doc_id {kind}, {columns}")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows of ``doc_id`` and ``ids`` (null: empty). An id outside the vocabulary fails."""
    texts, made = Vocabulary(path).text, []

    def batch(c):
        if not made:
            made.append(Decoder(texts))
        out = []
        for ids in c["ids"]:
            ids = np.array(ids or [], np.int64)
            if len(ids) and not 0 <= ids.min() <= ids.max() < len(texts):
                raise ValueError("an id is outside the vocabulary")
            out.append(made[0].decode(ids))
        return {"doc_id": c["doc_id"], "text": out}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows.select("doc_id", "ids"), batch, f"doc_id {kind}, text string")
