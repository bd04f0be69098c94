"""SentencePiece encoding: a suffix array finds every occurrence of every piece, and the edges are relaxed by position.

The models at hand merge pairs (BPE), so a path is not the best by a sum of scores. A sequence of pieces is what merging
gives exactly if every two neighbours are: merging their joint text gives the two again. An edge is therefore relaxed
only if its piece stands so beside the last piece of the path up to its start; one edge survives at each position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from vigiltx.llm.common import chunks, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words that a worker remembers; beyond it starts anew.
REMEMBERED = 150_000
#: Slots for the pairs of pieces that a worker remembers; of two that share one, the later one stays.
SLOTS = 1 << 21
_vocabularies: dict[int, Vocabulary] = {}


class Numbered(dict):
    """Numbers words from 0 on as they are asked for."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Vocabulary:
    """Pieces of a BPE model with byte fallback, what merging does to any two, and the words met so far."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        m, n = self.model, self.model.get_piece_size()
        self.piece = [m.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if m.is_byte(i)}
        if len(self.byte) < 256:
            raise ValueError("the model must fall back to bytes")
        own = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        self.score = {self.piece[i]: m.get_score(i) for i in own}
        self.id = {self.piece[i]: i for i in own}
        #: Text of each id as bytes: a byte, nothing for a control, else the piece with spaces.
        self.raw = [self.piece[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in self.byte.items():
            self.raw[i] = bytes([b])
        for i in range(n):
            if m.is_control(i):
                self.raw[i] = b""
            elif m.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
        #: In each slot a pair and, as its last bit, whether merging leaves it as it is.
        self.slots = np.full(SLOTS, -1, np.int64)
        reached = [i for i in own if self.merged(self.piece[i]) == [self.piece[i]]]
        #: The two parts that merging put together last, of each piece that it makes.
        self.halves = {self.piece[i]: tuple(self.merged(self.piece[i], 2)) for i in reached if len(self.piece[i]) > 1}
        alphabet = sorted({c for p in self.id for c in p})
        if len(alphabet) >= 0xFFFF:
            raise ValueError("the pieces use too many characters")
        self.alphabet = np.fromiter(map(ord, alphabet), np.uint32, len(alphabet))
        self.depth = max(len(self.piece[i]) for i in reached)
        self.reached = np.array(reached, np.int64)
        self.sizes = np.array([len(self.piece[i]) for i in reached], np.int64)
        self.spelled = np.zeros((len(reached), self.depth), np.uint16)
        for row, i in enumerate(reached):
            self.spelled[row, : len(self.piece[i])] = self.coded(self.piece[i])
        #: The least and the largest four characters that a text with the piece at its start can begin with.
        four = np.zeros((len(reached), 4), np.uint16)
        four[:, : self.depth] = self.spelled[:, :4]
        past = np.arange(4) >= self.sizes[:, None]
        self.head = self._four(four), self._four(np.where(past, 0xFFFF, four))
        self.length = np.ones(n, np.int64)
        self.length[self.reached] = self.sizes
        alone = "".join(c for c in "\n\t\r" if c not in alphabet)
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id)
        self.words = re.compile(f".[^{alone}]*|[{alone}]" if crossing else f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+|[{alone}]", re.S) if alone else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if not crossing else ".+", re.S)
        self.forget()

    def forget(self) -> None:
        self.index = Numbered()
        self.ends = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.int32)

    def coded(self, text: str) -> np.ndarray:
        """Characters as numbers from 1; 0 for one that no piece has."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, code), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == code, at + 1, 0).astype(np.uint16)

    def merged(self, text: str, least: int = 1) -> list[str]:
        """What merging makes of a short text, or its last ``least`` parts: the pair of the best piece first, the leftmost in a tie."""
        parts, score = list(text), self.score
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, keys: np.ndarray) -> np.ndarray:
        """For each pair (first * number of pieces + second), whether merging leaves the two as they are."""
        slot = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % SLOTS
        held = self.slots[slot]
        ok = (held & 1).astype(bool)
        new = np.flatnonzero(held >> 1 != keys)
        if len(new):
            every, back = np.unique(keys[new], return_inverse=True)
            piece, n = self.piece, len(self.piece)
            found = np.array([self.parted(piece[key // n], piece[key % n]) for key in every.tolist()], bool)
            ok[new] = found[back]
            self.slots[slot[new]] = keys[new] << 1 | ok[new]
        return ok

    def parted(self, a: str, b: str) -> bool:
        """Whether merging ``a + b`` gives ``a`` and ``b``: the merges that made the two are undone, the last one first.

        Both are what merging makes of their texts. At each step no merge across the border may come before the one
        undone last; of equal scores the left one comes first.
        """
        score, halves = self.score, self.halves
        limit, left = -np.inf, False
        while True:
            s = score.get(a + b)
            # Undone in ``a``, a merge of the same score stood left of the border, one in ``b`` right of it.
            if s is not None and (s > limit or (s == limit and not left)):
                return False
            sa, sb = score[a] if a in halves else np.inf, score[b] if b in halves else np.inf
            if sa == sb == np.inf:
                return True
            if sa < sb:
                limit, left, a = sa, True, halves[a][1]
            else:
                limit, left, b = sb, False, halves[b][0]

    def suffixes(self, code: np.ndarray) -> np.ndarray:
        """Positions in the order of the text that begins there, as far as a piece can reach."""
        wide = np.zeros(len(code) + self.depth, np.uint16)
        wide[: len(code)] = code
        order = np.arange(len(code))
        # From the last character that matters to the first; numbers of 16 bits are sorted in linear time.
        for d in reversed(range(self.depth)):
            order = order[np.argsort(wide[order + d], kind="stable")]
        return order

    @staticmethod
    def _four(codes: np.ndarray) -> np.ndarray:
        wide = codes.astype(np.uint64)
        return (wide[:, 0] << np.uint64(48)) | (wide[:, 1] << np.uint64(32)) | (wide[:, 2] << np.uint64(16)) | wide[:, 3]

    def ranges(self, code: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``spelled`` that occur, and their first and past-the-last places in the order of the suffixes."""
        wide = np.zeros(len(code) + self.depth, np.uint16)
        wide[: len(code)] = code
        # The first four characters are found as one number each, what follows character by character.
        begins = self._four(wide[np.minimum(order[:, None] + np.arange(4), len(wide) - 1)])
        low, high = np.searchsorted(begins, self.head[0]), np.searchsorted(begins, self.head[1], "right")
        rows = np.flatnonzero(low < high)
        low, high = low[rows], high[rows]
        whole = self.sizes[rows] <= 4
        done = [(rows[whole], low[whole], high[whole])]
        rows, low, high = rows[~whole], low[~whole], high[~whole]
        for d in range(4, self.depth):
            want = self.spelled[rows, d]
            found = []
            for past in (False, True):
                a, b = low.copy(), high.copy()
                while (a < b).any():
                    middle = (a + b) // 2
                    met = wide[order[np.minimum(middle, len(order) - 1)] + d]
                    right = (met <= want) if past else (met < want)
                    open_ = a < b
                    a = np.where(open_ & right, middle + 1, a)
                    b = np.where(open_ & ~right, middle, b)
                found.append(a)
            low, high = found
            whole = (self.sizes[rows] == d + 1) & (low < high)
            done.append((rows[whole], low[whole], high[whole]))
            on = (self.sizes[rows] > d + 1) & (low < high)
            rows, low, high = rows[on], low[on], high[on]
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))

    def learn(self, words: list[str]) -> None:
        """Encode new words, the last ones of the index, together."""
        code = self.coded("\x00".join(words) + "\x00")
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        last_place = first + size
        code[last_place] = 0
        order = self.suffixes(code).astype(np.int32)
        rows, low, high = self.ranges(code, order)
        count = high - low
        at = order[np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
        piece, end = np.repeat(self.reached[rows].astype(np.int32), count), at + np.repeat(self.sizes[rows].astype(np.int32), count)
        # A character that is no piece itself is an edge of its own, kept below zero.
        word = np.repeat(np.arange(len(words)), size + 1)
        inside = np.ones(len(code), bool)
        inside[last_place] = False
        single = np.zeros(len(self.alphabet) + 1, bool)
        single[self.spelled[self.sizes == 1, 0]] = True
        odd = np.flatnonzero(inside & ~single[code])
        odd = odd.astype(np.int32)
        at, piece, end = np.concatenate([at, odd]), np.concatenate([piece, np.full(len(odd), -1, np.int32)]), np.concatenate([end, odd + 1])
        level = (end - first[word[at]]).astype(np.int32)
        by = np.argsort(level.astype(np.uint16) if level.max(initial=0) < 1 << 16 else level, kind="stable")
        at, piece, end, level = at[by], piece[by], end[by], level[by]
        bounds = np.searchsorted(level, np.arange(1, level.max(initial=0) + 2))
        begins, odd_piece = -2, -1
        last = np.full(len(code) + 1, -3, np.int64)
        last[first] = begins
        n = len(self.piece)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            before, own = last[at[a:b]], piece[a:b]
            ok = before != -3
            both = (before >= 0) & (own >= 0)
            if both.any():
                ok[both] &= self.beside(before[both] * n + own[both].astype(np.int64))
            # Next to a character that is in no piece nothing merges; one that is only part of pieces is checked in full.
            last[end[a:b][ok]] = own[ok]
        self._collect(words, first, last_place, last, odd_piece)

    def _collect(self, words: list[str], first: np.ndarray, place: np.ndarray, last: np.ndarray, odd: int) -> None:
        """Walk all words back from their ends together, then spell out what has no piece."""
        place, alive = place.copy(), np.arange(len(words))
        owner, found, spot = [], [], []
        while len(alive):
            token = last[place[alive]]
            step = np.where(token >= 0, self.length[np.maximum(token, 0)], 1)
            place[alive] -= step
            owner.append(alive)
            found.append(token)
            spot.append(place[alive] - first[alive])
            alive = alive[place[alive] > first[alive]]
        owner, found, spot = map(np.concatenate, (owner, found, spot))
        by = np.lexsort((spot, owner))
        owner, found, spot = owner[by], found[by], spot[by]
        if (found == odd).any():
            times = np.ones(len(found), np.int64)
            odd_at = np.flatnonzero(found == odd)
            raw = [words[owner[i]][spot[i]].encode("utf-8", "replace") for i in odd_at]
            times[odd_at] = [len(r) for r in raw]
            spread = np.repeat(found, times)
            owner = np.repeat(owner, times)
            spread[spread == odd] = [self.byte[b] for r in raw for b in r]
            found = spread
        ends = np.cumsum(np.bincount(owner, minlength=len(words))) + self.ends[-1]
        self.ends = np.concatenate([self.ends, ends])
        self.flat = np.concatenate([self.flat, found.astype(np.int32)])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        lengths = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
        for a, b in chunks(lengths, 1 << 20):
            if len(self.index) >= REMEMBERED or len(self.index) >= len(self.ends):
                self.forget()
            split = [self.words.findall(self.model.normalize(t)) if t else [] for t in texts[a:b]]
            size = np.fromiter(map(len, split), np.int64, b - a)
            at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, size.sum())
            known = len(self.ends) - 1
            if len(self.index) > known:
                self.learn(list(islice(self.index, known, None)))
            count = self.ends[at + 1] - self.ends[at]
            past = np.concatenate([[0], np.cumsum(count)])
            ids = self.flat[np.repeat(self.ends[at] - past[:-1], count) + np.arange(past[-1])]
            out += np.split(ids, past[np.cumsum(size)[:-1]])
        return out

    def decode(self, ids: np.ndarray | None) -> str | None:
        """The text of ids: spaces for the mark, one less at the start, bytes put together."""
        if ids is None:
            return None
        ids = ids.tolist()
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        head = next((self.piece[i] for i in ids if self.raw[i]), "")
        return text[1:] if head.startswith(SPACE) else text


def vocabulary(content: bytes) -> Vocabulary:
    """Made once in each worker."""
    key = hash(content)
    if key not in _vocabularies:
        _vocabularies[key] = Vocabulary(content)
    return _vocabularies[key]


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, *, text: str = "text", path: str = MODEL) -> DataFrame:
    """``docs`` with ``pieces``, the ids of the text, and ``n_pieces``.

    The ids are those of the model's own merging, whatever the text: characters without a piece become bytes. A null
    or empty text has no ids. Long texts are encoded whole; words that return are looked up, words that are new in a
    batch are encoded together. Input columns named as an output are replaced.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_content(path))

    others = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*others or [F.lit(0)]).alias("_row"), F.col(text).cast("string").alias("_text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(shared.value)
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column("_text")), 0).to_numpy()
            for a, b in chunks(sizes, 1 << 20):
                part = whole.slice(a, b - a)
                ids = own.encode(part.column("_text").to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("_row"), part.column("_text"), lists], ["_row", "_text", "_pieces"])

    done = rows.mapInArrow(encoded, StructType([*rows.schema.fields, StructField("_pieces", ArrayType(IntegerType()))]))
    fields = [c for c in docs.columns if c.lower() not in ("pieces", "n_pieces")]
    kept = (F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in fields)
    return done.select(*kept, F.col("_pieces").alias("pieces"), F.size("_pieces").cast("long").alias("n_pieces"))


def decode(docs: DataFrame, *, pieces: str = "pieces", to: str = "decoded", path: str = MODEL) -> DataFrame:
    """``docs`` with the text of ``pieces`` as column ``to``; null ids give null, no ids the empty text."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_content(path))

    @pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = vocabulary(shared.value)
        for batch in batches:
            yield pd.Series([own.decode(ids) for ids in batch], dtype=object)

    fields = [c for c in docs.columns if c.lower() != to.lower()]
    return docs.select(*fields, decoded(pieces).alias(to))
