"""BPE encoding and decoding with an index of pair occurrences.

All new pre-tokens of a batch lie in one array of symbols. A pair index maps each
active rank to every position of its pair; ranks are applied in ascending order, each
at all its positions at once, and only the lists of pairs beside a merge are updated.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from seriesmill.llm.common import flat, pieces, prefix_sums, span_hashes, word_spans

def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable Latin-1, else 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = (x for x in range(256) if x not in plain)
    letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A word-level BPE vocabulary file: merges, end-of-word mark, special strings, pattern."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError("only vocabularies with NFC, white space, lower case, split and byte level are supported")
        self.ids = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.pattern = steps[0]["pattern"]["Regex"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.left = np.array([self.ids[a] for a, _ in merges], np.int64)
        self.right = np.array([self.ids[b] for _, b in merges], np.int64)
        self.made = np.array([self.ids[a + b] for a, b in merges], np.int32)
        born = {int(c): r for r, c in enumerate(self.made)}
        if len(born) < len(merges) or any(born.get(int(x), -1) >= r for r, ab in enumerate(zip(self.left, self.right, strict=True)) for x in ab):
            raise ValueError("a merge uses a symbol that only a later merge makes")
        key = self.left << 32 | self.right
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order
        letters = byte_letters()
        self.byte = np.array([self.ids[x] for x in letters], np.int32)
        self.last = np.array([self.ids[x + self.suffix] for x in letters], np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 if it is not in the merges."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


def encode_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and the number of ids of each."""
    size = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(size)
    sym = v.byte[raw]
    sym[ends - 1] = v.last[raw[ends - 1]]
    n = len(sym)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[ends - 1] = -1
    prv[ends - size] = -1
    alive = np.ones(n, bool)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(at: np.ndarray) -> None:
        rank = v.rank(sym[at], sym[nxt[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, found in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True):
            if r in index:
                index[r].append(found)
            else:
                index[r] = [found]
                heapq.heappush(active, r)

    add(np.flatnonzero(nxt >= 0))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        a, b, made = v.left[r], v.right[r], v.made[r]
        after = nxt[at]
        at = at[alive[at] & (sym[at] == a) & (after >= 0) & (sym[after] == b)]
        if a == b and len(at) > 1:
            joins = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
            first = np.maximum.accumulate(np.where(joins, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
        if not len(at):
            continue
        gone = nxt[at]
        rest = nxt[gone]
        sym[at] = made
        alive[gone] = False
        nxt[at] = rest
        prv[rest[rest >= 0]] = at[rest >= 0]
        before = prv[at]
        add(np.unique(np.concatenate((before[before >= 0], at[rest >= 0]))))
    owner = np.repeat(np.arange(len(words)), size)[alive]
    return sym[alive].astype(np.uint32), np.bincount(owner, minlength=len(words))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of each stretch, one stretch after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Table:
    """Rows of different length in one array that grows."""

    def __init__(self, kind):
        self.values, self.starts, self.sizes = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate((self.starts, len(self.values) + np.cumsum(sizes) - sizes))
        self.values = np.concatenate((self.values, values))
        self.sizes = np.concatenate((self.sizes, sizes))

    def rows(self, at: np.ndarray) -> np.ndarray:
        return self.values[ragged(self.starts[at], self.sizes[at])]


class Encoder:
    """Ids and decoded text of whole texts.

    Stretches without ASCII white space are known by a 64-bit hash; those seen before
    in the task are looked up, new ones are encoded together.
    """

    def __init__(self, v: Vocabulary, most: int = 400_000):
        self.v, self.most = v, most
        self.split = regex.compile(v.pattern)
        self.lines = regex.compile(v.pattern + r"|\n")
        self.marks = regex.compile("|".join(regex.escape(x) for x in sorted(v.special, key=len, reverse=True)) or r"(?!)")
        self.names = Table(np.uint8)
        names = [(v.names.get(i, "") + " ").encode() for i in range(max(v.names) + 1)]
        self.names.add(np.frombuffer(b"".join(names), np.uint8), np.array([len(x) for x in names]))
        self.clear()

    def clear(self) -> None:
        """Forget the stretches; results don't depend on when."""
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids = Table(np.uint32)

    def parts(self, chunk: str) -> list[str | int]:
        """Pre-tokens and ids of special strings."""
        out: list[str | int] = []
        at = 0
        for m in self.marks.finditer(chunk):
            out += self.plain(chunk[at : m.start()])
            out.append(self.v.special[m[0]])
            at = m.end()
        return out + self.plain(chunk[at:])

    def is_odd(self, chunk: str) -> bool:
        """It holds a special string, or needs more than lower case."""
        if not chunk.isascii() and ("Σ" in chunk or not unicodedata.is_normalized("NFC", chunk)):
            return True
        return any(x in chunk for x in self.v.special)

    def plain(self, text: str) -> list[str]:
        return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def learn(self, chunks: list[str]) -> None:
        """Encodes the distinct pre-tokens of new stretches together; rows follow in order."""
        odd = {k: self.parts(c) for k, c in enumerate(chunks) if self.is_odd(c)}
        plain = [c for k, c in enumerate(chunks) if k not in odd]
        found = self.lines.findall("\n".join(plain).lower()) if plain else []
        known: dict[str | int, int] = {"\n": 0}
        for x in found:
            known.setdefault(x, len(known))
        for parts in odd.values():
            for x in parts:
                known.setdefault(x, len(known))
        at = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
        breaks = at == 0
        rest = np.fromiter((k for k in range(len(chunks)) if k not in odd), np.int64, len(plain))
        owner = rest[np.cumsum(breaks)[~breaks]] if plain else np.zeros(0, np.int64)
        at = np.concatenate((at[~breaks], np.array([known[x] for parts in odd.values() for x in parts], np.int64)))
        owner = np.concatenate((owner, np.repeat(np.array(list(odd), np.int64), [len(x) for x in odd.values()])))
        order = np.argsort(owner, kind="stable")
        at, owner = at[order], owner[order]

        names = list(known)[1:]
        words = [x.encode() for x in names if isinstance(x, str)]
        is_word = np.array([False] + [isinstance(x, str) for x in names], bool)
        ids, size = encode_words(words, self.v) if words else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        sizes = np.ones(len(known), np.int64)
        sizes[is_word] = size
        values = np.zeros(sizes.sum(), np.uint32)
        of_word = np.repeat(is_word, sizes)
        values[of_word] = ids
        values[~of_word] = [0] + [x for x in names if not isinstance(x, str)]
        rows = Table(np.uint32)
        rows.add(values, sizes)
        self.ids.add(rows.rows(at), np.bincount(owner, weights=sizes[at], minlength=len(chunks)).astype(np.int64))

    def look_up(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Row in ``ids`` of each stretch of ``data``."""
        value = span_hashes(prefix_sums(data), begin, end)
        distinct, first, back = np.unique(value, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            raw, n = data.tobytes(), len(self.ids.sizes)
            self.learn([raw[a:b].decode() for a, b in zip(begin[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            known = np.concatenate((self.known, distinct[new]))
            place = np.concatenate((self.place, np.arange(n, n + new.sum())))
            order = np.argsort(known, kind="stable")
            self.known, self.place = known[order], place[order]
            at = np.searchsorted(self.known, distinct)
        return self.place[at][back]

    def encode(self, texts: pa.Array) -> tuple[list[bytes], list[bytes], np.ndarray]:
        """Packed ids, decoded text (UTF-8) and number of ids of each text."""
        if len(self.known) > self.most:
            self.clear()
        data, starts = flat(texts)
        begin, end, owner = word_spans(data, starts)
        at = self.look_up(data, begin, end) if len(begin) else np.zeros(0, np.int64)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        packed, decoded, n = [], [], np.zeros(len(texts), np.int64)
        for i in range(len(texts)):
            ids = self.ids.rows(at[cuts[i] : cuts[i + 1]])
            n[i] = len(ids)
            packed.append(ids.astype("<u4").tobytes())
            decoded.append(self.names.rows(ids).tobytes()[:-1])
        return packed, decoded, n


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers, packed) and ``decoded``.

    ``vocabulary`` is the content of the vocabulary file. A null text counts as empty:
    no ids, decoded text empty. Columns of ``docs`` with these names are replaced.
    Rows are independent: no shuffle, whole texts, any number of tasks.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("n_tokens", "ids", "decoded")]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(shared.value))
        for batch in batches:
            for part in pieces(batch, text):
                packed, decoded, n = encoder.encode(part.column(text))
                columns = [part.column(f.name) for f in kept] + [pa.array(n), pa.array(packed, pa.binary()), pa.array(decoded, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ["n_tokens", "ids", "decoded"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_tokens long", "ids binary", "decoded string"])
    return docs.mapInArrow(run, schema)
