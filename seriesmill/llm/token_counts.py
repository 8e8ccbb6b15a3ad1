"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch lie in one array of symbols, one ragged row each.
In every step all rows merge their own lowest-rank pair at the same time; rows without
a pair left are done, and the surviving symbols are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from seriesmill.llm.common import flat, pieces, prefix_sums, span_hashes

#: The mark that stands for a space.
SPACE = "▁"


class PieceVocabulary:
    """A BPE piece model with byte fallback: which piece two neighbours make, and its rank."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        usual = [i for i in range(len(pieces)) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in usual):
            raise ValueError("a piece holds a space after another sign: words can't be counted one by one")
        if sp.encode(" a", out_type=str) != sp.encode(SPACE + "a", out_type=str) or len(sp.encode("\uffff")) != 4:
            raise ValueError("only models that keep spaces as marks and fall back to bytes are supported")
        ids = {pieces[i]: i for i in usual}
        self.single = np.zeros(0x110000, np.int32)
        points = np.arange(0x110000)
        self.single[:] = -(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))
        for piece, i in ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = i
        scores = np.array(sorted({sp.get_score(i) for i in usual}, reverse=True))
        rank = {i: int(np.searchsorted(-scores, -sp.get_score(i))) for i in usual}
        pairs = [(ids[p[:k]], ids[p[k:]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        left, right, made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        key = left << 32 | right
        order = np.argsort(key)
        self.keys, self.made = key[order], made[order].astype(np.int32)
        self.ranks = np.array([rank[i] for i in self.made.tolist()], np.int32)
        self.none = np.int32(len(scores))

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair in the table; -1 if it makes no piece."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), at, -1)


def surviving(sym: np.ndarray, size: np.ndarray, v: PieceVocabulary) -> np.ndarray:
    """Tokens of each ragged row of symbols after all merges.

    Within a row a merge of the lowest rank is done at several places at once, from
    the left, up to the first that gives a neighbour pair of the same or a lower rank:
    that pair is next in turn.
    """
    counts = np.zeros(len(size), np.int64)
    names = np.flatnonzero(size > 0)
    size = size[names]
    pair = None
    while len(names):
        starts = np.cumsum(size) - size
        row = np.repeat(np.arange(len(names)), size)
        if pair is None:
            pair = np.full(len(sym), -1, np.int64)
            pair[:-1] = v.find(sym[:-1], sym[1:])
            pair[starts + size - 1] = -1
        rank = np.where(pair >= 0, v.ranks[pair], v.none)
        least = np.minimum.reduceat(rank, starts)
        done = least == v.none
        if done.any():
            gone = done[row]
            counts[names[done]] = np.add.reduceat(np.where(sym >= 0, 1, -sym), starts)[done]
            sym, pair, rank, names, size, least = sym[~gone], pair[~gone], rank[~gone], names[~done], size[~done], least[~done]
            if not len(names):
                break
            starts = np.cumsum(size) - size
            row = np.repeat(np.arange(len(names)), size)
        at = np.flatnonzero(rank == least[row])
        # Of places that overlap, every second one from the left.
        joins = np.concatenate(([False], at[1:] == at[:-1] + 1))
        run = np.maximum.accumulate(np.where(joins, 0, np.arange(len(at))))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        made, of, here = v.made[pair[at]], row[at], rank[at]
        begins, ends = starts[of], starts[of] + size[of]
        # Neighbours as they are when this place's turn comes: all places to the left are merged.
        before = sym[np.maximum(at - 1, 0)]
        if len(at) > 1:
            beside = np.concatenate(([False], at[1:] == at[:-1] + 2))
            before[beside] = made[np.flatnonzero(beside) - 1]
        left = np.where(at > begins, v.find(before, made), -1)
        right = np.where(at + 2 < ends, v.find(made, sym[np.minimum(at + 2, len(sym) - 1)]), -1)
        early = ((left >= 0) & (v.ranks[left] <= here)) | ((right >= 0) & (v.ranks[right] <= here))
        if early.any():
            opens = np.concatenate(([True], of[1:] != of[:-1]))
            seen = np.cumsum(early) - early
            seen -= np.maximum.accumulate(np.where(opens, seen, 0))
            keep = seen == 0
            at, made, of = at[keep], made[keep], of[keep]
        sym[at] = made
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        new = (np.cumsum(stay) - 1)[at]
        sym, pair = sym[stay], pair[stay]
        size = size - np.bincount(of, minlength=len(size))
        ends = np.cumsum(size)
        last = np.zeros(len(sym), bool)
        last[ends - 1] = True
        first = np.zeros(len(sym), bool)
        first[ends - size] = True
        fresh = np.unique(np.concatenate((new, new[~first[new]] - 1)))
        nxt = np.minimum(fresh + 1, len(sym) - 1)
        pair[fresh] = np.where(last[fresh], -1, v.find(sym[fresh], sym[nxt]))
    return counts


class Counter:
    """Tokens of whole texts; words seen before in the task are looked up."""

    def __init__(self, v: PieceVocabulary, most: int = 600_000):
        self.v, self.most = v, most
        self.known, self.tokens = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def learn(self, words: list[bytes]) -> np.ndarray:
        text = [SPACE + w.decode().replace(" ", SPACE) for w in words]
        points = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
        return surviving(self.v.single[points], np.array([len(x) for x in text], np.int64), self.v)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text: 0 if it is empty."""
        data, starts = flat(texts)
        total = np.zeros(len(texts), np.int64)
        if not len(data):
            return total
        if len(self.known) > self.most:
            self.known, self.tokens = self.known[:0], self.tokens[:0]
        begin, end, owner = self.words(data, starts)
        value = span_hashes(prefix_sums(data), begin, end)
        distinct, first, back = np.unique(value, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(begin[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            known, tokens = np.concatenate((self.known, distinct[new])), np.concatenate((self.tokens, self.learn(words)))
            order = np.argsort(known, kind="stable")
            self.known, self.tokens = known[order], tokens[order]
            at = np.searchsorted(self.known, distinct)
        return np.bincount(owner, weights=self.tokens[at][back], minlength=len(texts)).astype(np.int64)

    @staticmethod
    def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of spaces with what follows up to the next space.

        The mark put before each text, or the space that a word begins with, is left
        out: every stretch is counted with one mark before it. A text that begins
        with a mark of its own is the same as one that begins with a space.
        """
        mark = np.frombuffer(SPACE.encode(), np.uint8)
        space = data == 32
        hit = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])) if len(data) > 2 else np.zeros(0, np.int64)
        space[hit] = space[hit + 1] = space[hit + 2] = True
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        at = np.flatnonzero(opens)
        width = np.where(data[at] == 32, 1, 3)
        full = starts[:-1][starts[1:] > starts[:-1]]
        # A run of spaces inside a text opens a stretch, whose first space is left out; a text opens one too.
        inner = ~np.isin(at, full)
        begin = np.concatenate((full, at[inner] + width[inner]))
        cut = np.concatenate((full, at[inner]))
        order = np.argsort(cut, kind="stable")
        begin, cut = begin[order], cut[order]
        end = np.concatenate((cut[1:], [len(data)]))
        return begin, end, np.searchsorted(starts, cut, "right") - 1


def token_counts(docs: DataFrame, model: bytes, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text, without begin and end.

    ``model`` is the content of the piece model. A null or empty text has none. A
    column of ``docs`` named ``out`` is replaced. Rows are independent: no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name != out]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(PieceVocabulary(shared.value))
        for batch in batches:
            for part in pieces(batch, text):
                columns = [part.column(f.name) for f in kept] + [pa.array(counter.count(part.column(text)))]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + [out])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{out}` long"])
    return docs.mapInArrow(run, schema)
