"""Exact repeated 50-byte strings by a distributed merge sort of front-coded suffix runs.

Every string of ``size`` bytes has an anchor: the place of its smallest q-gram hash.
Equal strings have equal anchors, so only suffixes that start at anchors are sorted.

1. Fingerprints of the anchors' q-grams are exchanged in sorted, delta-coded runs;
   only anchors whose q-gram stands in several documents go on. At q-grams with very
   many occurrences the strings themselves go on, one by one.
2. Each piece of the input sorts the suffixes at those anchors and exchanges them as
   front-coded runs (common prefix with the one before, and the rest).
3. The runs of a range are combined by a loser tree that compares common-prefix
   lengths first and bytes only beyond what is known to be equal. From the sorted
   suffixes with their common prefixes follows which strings also start in a smaller
   document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import flat, mixed, pieces, planes, prefix_sums, ranges, rolling, span_hashes, u64, unplanes, written

#: Runs that one loser tree combines.
FAN_IN = 256
#: Bytes of text for each range of the exchanges.
RANGE_BYTES = 4 << 20
#: Occurrences of a q-gram from which its strings are sent one by one.
OFTEN = 1 << 14


def _slide(a: np.ndarray, w: int, op: np.ufunc) -> np.ndarray:
    """``op`` (a minimum or maximum) over every ``w`` neighbours: stretches are doubled, the last two overlap."""
    n, have = len(a) - w + 1, 1
    if n <= 0:
        return a[:0]
    while 2 * have <= w:
        a = op(a[:-have], a[have:])
        have *= 2
    return op(a[:n], a[w - have : w - have + n])


def _rows_at(data: np.ndarray, at: np.ndarray, size: int, here: np.ndarray) -> np.ndarray:
    """``size`` bytes from each place on, of which the first ``here`` count; the others are 0."""
    padded = np.concatenate((data, np.zeros(size, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, size)[at]
    short = np.flatnonzero(here < size)
    rows[short] *= np.arange(size) < here[short, None]
    return rows


class Anchors:
    """Anchors of a batch of texts: place, q-gram hash, and the smallest hash of each string."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, size: int, q: int):
        self.data, self.starts, self.size, self.q = data, starts, size, q
        self.w = size - q + 1
        self.at, self.hash, self.least = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        n = len(data) - size + 1
        if n <= 0:
            self.text = self.at
            return
        grams = rolling(data, q) | np.uint64(1)
        least = _slide(grams, self.w, np.minimum)
        for end in starts[1:].tolist():
            least[max(0, end - size + 1) : end] = 0  # a string never crosses texts
        edge = np.zeros(self.w - 1, np.uint64)
        self.least = np.concatenate((edge, least, edge))
        self.at = np.flatnonzero(_slide(self.least, self.w, np.maximum) == grams)
        self.hash = grams[self.at]
        self.text = np.searchsorted(starts, self.at, "right") - 1

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the q-grams, index of each anchor's, and occurrences. Smallest hashes lie low, their keys are spread."""
        return np.unique(mixed(self.hash), return_inverse=True, return_counts=True)

    def masks(self, some: np.ndarray) -> np.ndarray:
        """Bit j: the anchor is that of the string that starts j bytes before it."""
        out = np.zeros(len(some), np.int64)
        for j in range(self.w):
            out |= (self.least[self.at[some] - j + self.w - 1] == self.hash[some]).astype(np.int64) << j
        return out


def packed(docs: DataFrame, text: str) -> DataFrame:
    """Pieces ``(piece, ids, sizes, z)`` of the table: some documents' texts, compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in pieces(batch, text, 1 << 20):
                data, starts = flat(part.column(text))
                ids = pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([np.diff(starts)], pa.list_(pa.int64())), pa.array([z.compress(data.tobytes())], pa.binary())], ["ids", "sizes", "z"])

    rows = docs.select("doc_id", text).filter("doc_id IS NOT NULL").mapInArrow(run, "ids array<long>, sizes array<long>, z binary")
    return written(rows.select(F.monotonically_increasing_id().alias("piece"), "*"))


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.decompress(row["z"]), np.uint8)
    return data, np.concatenate(([0], np.cumsum(np.array(row["sizes"], np.int64)))), np.array(row["ids"], np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _send(z, piece: int, part: np.ndarray, blob) -> pa.RecordBatch:
    """A row for each part: ``blob(a, b)`` packs the entries of one, given in order of the parts."""
    cuts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)])) if len(part) else np.zeros(1, np.int64)
    blobs = [z.compress(blob(a, b)) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]], pa.int64()), pa.array(np.full(len(blobs), piece)), pa.array(blobs, pa.binary())], ["part", "piece", "blob"])


def _answers(column: list[dict] | None, unpack) -> np.ndarray:
    """The answers of all parts to one piece, in the order of the entries sent."""
    got = [unpack(zstandard.decompress(x["blob"])) for x in sorted(column or (), key=lambda x: x["part"])]
    return np.concatenate(got) if got else np.zeros(0, np.int64)


class Entries:
    """Anchors of a piece that go on, one for each context that its smallest document has.

    A string at a q-gram that stands very often is an entry of its own: its start takes
    the place of the anchor, and its range is that of its own hash.
    """

    def __init__(self, row: dict, size: int, q: int, n_parts: int):
        self.data, self.starts, self.ids = _open(row)
        a = Anchors(self.data, self.starts, size, q)
        distinct, back, _ = a.distinct()
        low, high = np.full(len(distinct), 2**62), np.full(len(distinct), -(2**62))
        np.minimum.at(low, back, self.ids[a.text])
        np.maximum.at(high, back, self.ids[a.text])
        seen = _answers(row["seen"], lambda b: np.frombuffer(b, np.uint8)).astype(np.uint8)
        use = np.flatnonzero(((low != high) | (seen & 1 == 1))[back]) if len(distinct) else np.zeros(0, np.int64)
        self.mask = a.masks(use)
        often = (seen > 1)[back[use]]
        begins = np.zeros(len(self.data), bool)  # of strings at frequent q-grams, each once whatever its anchors
        for j in range(a.w):
            begins[a.at[use[often & (self.mask >> j & 1 == 1)]] - j] = True
        own = np.flatnonzero(begins)
        use, self.mask = use[~often], np.concatenate((self.mask[~often], np.ones(len(own), np.int64)))
        self.at = np.concatenate((a.at[use], own))
        texts = np.searchsorted(self.starts, self.at, "right") - 1
        self.doc = self.ids[texts]
        sums = prefix_sums(self.data)
        key = np.concatenate((mixed(a.hash[use]), span_hashes(sums, own, own + size)))
        # Of equal contexts only that of the smallest document is sent.
        far = np.zeros(len(self.at), np.int64)
        near = np.zeros(len(self.at), np.int64)
        for j in range(a.w):
            has = self.mask >> j & 1 == 1
            far[has] = j
            near[has & (near == 0)] = j + 1
        context = span_hashes(sums, self.at - far, self.at - near + 1 + size)
        context = mixed(context ^ mixed(self.mask.astype(np.uint64) + u64(77)))
        order = np.lexsort((self.doc, context))
        opens = np.ones(len(order), bool)
        opens[1:] = context[order][1:] != context[order][:-1]
        first = order[opens]
        self.group = np.zeros(len(order), np.int64)
        self.group[order] = np.cumsum(opens) - 1
        at, text = self.at[first], texts[first]
        suffix = _rows_at(self.data, at, size, self.starts[text + 1] - at)
        inside = np.where(first < len(use), at - self.starts[text], 0)
        before = _rows_at(self.data[::-1], len(self.data) - at, a.w - 1, inside)
        part = ranges(key[first], n_parts)
        order = np.lexsort((suffix.view(f"S{size}").ravel(), part)) if len(first) else first
        self.sent, self.part = first[order], part[order]
        self.suffix, self.before = suffix[order], before[order]
        self.number = np.zeros(len(first), np.int64)
        self.number[order] = np.arange(len(order))

    def run(self, a: int, b: int) -> bytes:
        """A front-coded run: common prefixes with the entry before, the rests, then the other columns."""
        s = self.suffix[a:b]
        differ = s[1:] != s[:-1]
        common = np.concatenate(([0], np.where(differ.any(1), differ.argmax(1), s.shape[1]))).astype(np.uint8)
        rest = s[np.arange(s.shape[1])[None, :] >= common[:, None]]
        return b"".join(
            [
                np.array([b - a], "<u4").tobytes(),
                common.tobytes(),
                planes(self.mask[self.sent[a:b]]),
                planes(self.doc[self.sent[a:b]]),
                np.ascontiguousarray(self.before[a:b].T).tobytes(),
                rest.tobytes(),
            ]
        )

    def kept(self) -> bytes:
        """What ``covered`` needs besides the answers: places, strings and numbers of the entries sent for them."""
        if not len(self.at):
            return b""
        rank = self.number[self.group]
        later = self.doc > self.doc[self.sent][rank]
        return planes(np.diff(self.at, prepend=0)) + planes(self.mask) + planes(2 * rank + later)


def covered(kept: bytes, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a piece's anchors and masks of their covered strings, from the answers to those sent."""
    n = len(kept) // 24
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, mask, rank = (unplanes(kept[8 * n * k : 8 * n * (k + 1)], np.int64) for k in range(3))
    return np.cumsum(at), np.where(rank & 1 == 1, mask, answer[rank >> 1])


class Run:
    """A decoded run: suffixes as numbers, and common prefixes with the entry before."""

    def __init__(self, raw: bytes, size: int, w: int):
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        at = 4
        self.common = raw[at : at + n]
        at += n
        self.mask = unplanes(raw[at : at + 8 * n], np.int64)
        at += 8 * n
        self.doc = unplanes(raw[at : at + 8 * n], np.int64)
        at += 8 * n
        self.before = np.frombuffer(raw, np.uint8, n * (w - 1), at).reshape(w - 1, n)
        at += n * (w - 1)
        self.value, last = [], b""
        for c in self.common:
            last = last[:c] + raw[at : at + size - c]
            at += size - c
            self.value.append(int.from_bytes(last, "big"))


def merge(values: list[list[int]], commons: list[list[int]], size: int) -> tuple[list[int], list[int], list[int]]:
    """Loser tree over sorted runs: order (run after run numbering), values and common prefixes.

    Each run's head knows its common prefix with the last winner. Of two heads the one
    with the longer common prefix is the smaller, without looking at bytes; at equal
    length only what follows is compared, and the loser learns its common prefix with
    the winner.
    """
    k = 1
    while k < len(values):
        k *= 2
    base, total = [], 0
    for v in values:
        base.append(total)
        total += len(v)
    end = 1 << (8 * size)  # larger than every suffix
    head = [v[0] if v else end for v in values] + [end] * (k - len(values))
    place = [0] * k
    known = [0] * k  # common prefix of each head with the last winner
    loser = [0] * k
    bits = 8 * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two heads."""
        ka, kb = known[a], known[b]
        if ka != kb:
            return (a, b) if ka > kb else (b, a)
        x, y = head[a], head[b]
        if x == y:
            if a > b:
                a, b = b, a
            known[b] = size if x != end else 0
            return a, b
        common = (bits - (x ^ y).bit_length()) // 8 if x != end and y != end else 0
        if x < y:
            known[b] = common
            return a, b
        known[a] = common
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(build(2 * node), build(2 * node + 1))
        loser[node] = b
        return a

    winner = build(1) if k > 1 else 0
    order, out, common = [], [], []
    prefix = 0
    while head[winner] != end:
        i = place[winner]
        order.append(base[winner] + i)
        out.append(head[winner])
        common.append(prefix)
        i += 1
        place[winner] = i
        run = values[winner]
        if i < len(run):
            head[winner] = run[i]
            known[winner] = commons[winner][i]
        else:
            head[winner] = end
            known[winner] = -1  # loses to every other head
        node = (winner + k) >> 1
        while node:
            other = loser[node]
            kw, ko = known[winner], known[other]
            if kw < ko:
                loser[node], winner = winner, other
            elif kw == ko:
                winner, loser[node] = play(winner, other)
            node >>= 1
        prefix = max(known[winner], 0)
    return order, out, common


def merge_all(runs: list[Run], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of all runs, ``FAN_IN`` at a time."""
    level = []
    total = 0
    for r in runs:
        level.append((np.arange(total, total + len(r.value)), r.value, list(r.common)))
        total += len(r.value)
    while len(level) > 1:
        above = []
        for a in range(0, len(level), FAN_IN):
            group = level[a : a + FAN_IN]
            order, values, common = merge([g[1] for g in group], [g[2] for g in group], size)
            names = np.concatenate([g[0] for g in group])
            above.append((names[np.array(order, np.int64)], values, common))
        level = above
    return (level[0][0], np.array(level[0][2], np.int64)) if level else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def strings_covered(common: np.ndarray, mask: np.ndarray, doc: np.ndarray, before: np.ndarray, size: int) -> np.ndarray:
    """For sorted suffixes: mask of the strings that also start in a smaller document.

    The string j bytes before an anchor is the same in two entries if the suffixes
    have size - j bytes in common and the j bytes before them are equal.
    """
    out = np.zeros(len(mask), np.int64)
    left = np.zeros(len(mask), np.uint64)
    for j in range(before.shape[0] + 1):
        if j:
            left = mixed(left * np.uint64(3) + before[j - 1].astype(np.uint64) + np.uint64(1))
        some = np.flatnonzero(mask >> j & 1)
        right = np.cumsum(common < size - j)[some]
        alike = np.zeros(len(some) + 1, bool)
        alike[1:-1] = right[1:] == right[:-1]
        alike = alike[1:] | alike[:-1]  # others stand alone
        some, right = some[alike], right[alike]
        order = np.lexsort((left[some], right))
        some, right = some[order], right[order]
        l, d = left[some], doc[some]
        opens = np.ones(len(order), bool)
        opens[1:] = (l[1:] != l[:-1]) | (right[1:] != right[:-1])
        least = np.minimum.reduceat(d, np.flatnonzero(opens))[np.cumsum(opens) - 1] if len(d) else d
        out[some[d > least]] |= 1 << j
    return out


def remove_repeats(docs: DataFrame, text: str = "text", size: int = 50, q: int = 24) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for each document, ``kept`` in bytes.

    A byte of the UTF-8 text goes if it lies in a string of ``size`` bytes that also
    starts in a document with a smaller doc_id, judged on the input. A null text is
    empty. Rows without doc_id are left out; rows that share one don't remove each
    other's bytes. Strings are compared by 64-bit hashes left of their anchor and by
    their bytes from it on.

    A string is sent once by each piece of the input that has it. A range holds the
    entries of a q-gram only up to ``OFTEN`` occurrences in the table; beyond, its
    strings are dealt by their own hashes, whatever stands beside them.
    """
    whole = packed(docs, text)
    # A range is what a task holds at once: four for each task, more where the text asks for it.
    n_bytes = whole.agg(F.expr("sum(aggregate(sizes, 0L, (a, b) -> a + b))")).first()[0] or 0
    n_parts = max(4 * max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), -(-n_bytes // RANGE_BYTES))
    often = OFTEN
    w = size - q + 1

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for row in _rows(batches):
            data, starts, _ = _open(row)
            keys, _, times = Anchors(data, starts, size, q).distinct()
            yield _send(z, row["piece"], ranges(keys, n_parts), lambda a, b, h=keys, t=times: planes(np.diff(h[a:b], prepend=np.uint64(0))) + planes(t[a:b]))

    def count(table: pa.Table) -> pa.Table:
        got, times = [], []
        for x in table["blob"].to_pylist():
            raw = zstandard.decompress(x)
            got.append(np.cumsum(unplanes(raw[: len(raw) // 2], np.uint64), dtype=np.uint64))
            times.append(unplanes(raw[len(raw) // 2 :], np.int64))
        _, back, number = np.unique(np.concatenate(got), return_inverse=True, return_counts=True)
        total = np.bincount(back, np.concatenate(times))
        # Bit 0: in several pieces. Bit 1: very often.
        seen = (number > 1).astype(np.uint8) | (total > often).astype(np.uint8) << 1
        seen = np.split(seen[back], np.cumsum([len(x) for x in got])[:-1])
        return pa.table({"part": table["part"], "piece": table["piece"], "blob": pa.array([zstandard.compress(x.tobytes(), 1) for x in seen], pa.binary())})

    row = "part long, piece long, blob binary"
    seen = whole.mapInArrow(tell, row).groupBy("part").applyInArrow(count, row)
    seen = written(seen.groupBy("piece").agg(F.collect_list(F.struct("part", "blob")).alias("seen")))
    asked = whole.join(seen, "piece", "left")

    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for row in _rows(batches):
            e = Entries(row, size, q, n_parts)
            yield _send(z, row["piece"], e.part, e.run)
            own = n_parts + row["piece"] % n_parts  # comes back to the piece as it is
            yield _send(z, row["piece"], np.array([own]), lambda a, b, e=e: e.kept())

    def combine(table: pa.Table) -> pa.Table:
        if table["part"][0].as_py() >= n_parts:
            return table.select(["part", "piece", "blob"])
        runs = [Run(zstandard.decompress(x), size, w) for x in table["blob"].to_pylist()]
        order, common = merge_all(runs, size)
        mask, doc = (np.concatenate([getattr(r, c) for r in runs])[order] for c in ("mask", "doc"))
        before = np.concatenate([r.before for r in runs], axis=1)[:, order]
        found = np.zeros(len(order), np.int64)
        found[order] = strings_covered(common, mask, doc, before, size)
        each = np.split(found, np.cumsum([len(r.value) for r in runs])[:-1])
        return pa.table({"part": table["part"], "piece": table["piece"], "blob": pa.array([zstandard.compress(planes(x), 1) for x in each], pa.binary())})

    found = asked.mapInArrow(exchange, row).groupBy("part").applyInArrow(combine, row)
    found = written(found.groupBy("piece").agg(F.collect_list(F.struct("part", "blob")).alias("found")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            data, starts, ids = _open(row)
            answers = [x for x in row["found"] if x["part"] < n_parts]
            kept = next(x["blob"] for x in row["found"] if x["part"] >= n_parts)
            at, mask = covered(zstandard.decompress(kept), _answers(answers, lambda b: unplanes(b, np.int64)))
            edge = np.zeros(len(data) + size + 1, np.int8)
            for j in range(w):
                edge[at[mask >> j & 1 == 1] - j] = 1  # whether a covered string starts here
            begins = np.flatnonzero(edge)
            edge[begins + size] -= 1  # 0 where the next string starts
            gone = np.cumsum(edge, dtype=np.int32)[: len(data)] > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = starts[(starts > 0) & (starts < len(gone))]
            opens[inner] = gone[inner]
            sums, runs = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(opens)))
            left = data[~gone].tobytes()
            to = (starts - sums[starts]).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.diff(starts)), pa.array(np.diff(sums[starts])), pa.array(np.diff(runs[starts])), pa.array([left[a:b] for a, b in zip(to[:-1], to[1:], strict=True)], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return whole.join(found, "piece").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
