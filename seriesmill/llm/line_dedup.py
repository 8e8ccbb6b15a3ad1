"""Line deduplication by an exact set-similarity join.

Tokens of a line are ordered by rarity; only the tokens of its prefix are exchanged.
Lines that share one are candidates if length, position and a token bitmap as wide as
their sizes ask for allow the similarity; their whole token sets are compared afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import bit_table, flat, free_memory, lean_batches, lower_ascii, MARKS, mixed, owners, pieces, planes, prefix_sums, ranges, span_hashes, Scratch, u64, unplanes, word_spans, written

#: Tokens are counted in so many buckets; any order is right, the counts make it a rare-first one.
BUCKETS = 1 << 23
#: Ranges of buckets that counts travel in.
COUNTED = 1 << 10
#: Pairs looked at at once.
BLOCK = 100_000
#: Bytes of text that one step of a task holds, and of those whose lines are stored together.
PIECE = (1 << 19) - 16
STORED = (1 << 20) - 16
#: Entries of prefix tokens that are packed together.
PACKED = 1 << 16
#: Sets of at least so many tokens have bitmaps of two words of 64 bits, and of four.
TWO, FOUR = 64, 192


def _line_starts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each line begins, the index of its text and its number in it."""
    ends = np.flatnonzero(data == 10)
    at = np.unique(np.concatenate((starts[:-1][starts[1:] > starts[:-1]], ends + 1)))
    at = at[at < len(data)]
    text = np.searchsorted(starts, at, "right") - 1
    return at, text, np.searchsorted(ends, at) - np.searchsorted(ends, starts[text])


class Lines:
    """Token sets of the lines of a batch of texts, one after another, each token once.

    ``known`` are the distinct tokens of the batch, ascending, ``id`` the place in it of each
    token of a set, ascending within the set.
    """

    def __init__(self, texts: pa.Array, docs: np.ndarray):
        data, starts = flat(texts)
        line_starts, text, number = _line_starts(data, starts)
        low = lower_ascii(data)
        begin, end, _ = word_spans(low, starts)
        line = owners(begin, line_starts) if len(begin) else begin
        token = span_hashes(prefix_sums(low), begin, end)
        order = _order(token)
        ranked = token[order]
        new = _changes(ranked)
        id_ = np.empty(len(token), np.int64)
        id_[order] = np.cumsum(new) - 1
        line, id_ = _sorted(line, id_)
        new = _changes(line) | _changes(id_)
        line, id_ = line[new], id_[new]
        first = np.flatnonzero(_changes(line))
        line = line[first]
        self._take(ranked[_changes(ranked)], id_, np.diff(np.concatenate((first, [len(id_)]))), docs[text[line]], number[line])

    def _take(self, known: np.ndarray, id_: np.ndarray, size: np.ndarray, doc: np.ndarray, line: np.ndarray) -> None:
        self.known, self.id, self.size, self.doc, self.line = known, id_, size, doc, line
        self.first = np.cumsum(size) - size
        self.row = np.repeat(np.arange(len(size)), size)

    @property
    def token(self) -> np.ndarray:
        return self.known[self.id]

    def only(self, some: np.ndarray) -> Lines:
        """Those of the lines that are marked."""
        out = Lines.__new__(Lines)
        out._take(self.known, self.id[some[self.row]], self.size[some], self.doc[some], self.line[some])
        return out

    def packed(self) -> bytes:
        step = np.diff(self.id, prepend=0)
        step[self.first] = self.id[self.first]
        arrays = [np.diff(self.known, prepend=np.uint64(0)), step.astype(np.int32), self.size.astype(np.int32), np.diff(self.doc, prepend=0), np.diff(self.line, prepend=0)]
        head = np.array([len(self.known), len(self.id), len(self.size)], np.int64).tobytes()
        return zstandard.compress(head + b"".join(planes(x) for x in arrays), 1)

    @classmethod
    def unpacked(cls, blob: bytes) -> Lines:
        raw = zstandard.decompress(blob)
        n_known, n, n_lines = np.frombuffer(raw, np.int64, 3).tolist()
        found, at = [], 24
        for count, kind in ((n_known, np.uint64), (n, np.int32), (n_lines, np.int32), (n_lines, np.int64), (n_lines, np.int64)):
            to = at + count * np.dtype(kind).itemsize
            found.append(unplanes(raw[at:to], kind))
            at = to
        known, step, size, doc, line = found
        sums = np.concatenate(([0], np.cumsum(step, dtype=np.int64)))
        size = size.astype(np.int64)
        id_ = sums[1:] - np.repeat(sums[np.cumsum(size) - size], size)
        out = cls.__new__(cls)
        out._take(np.cumsum(known, dtype=np.uint64), id_, size, np.cumsum(doc), np.cumsum(line))
        return out

    def keys(self) -> list[np.ndarray]:
        """128-bit hash of each set."""
        out = []
        for salt in (3, 4):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(self.known + u64(salt * 0x9E3779B97F4A7C15))[self.id])))
            out.append(mixed(sums[self.first + self.size] - sums[self.first] + self.size.astype(np.uint64)).view(np.int64))
        return out


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before; the first does."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _order(token: np.ndarray) -> np.ndarray:
    """An ascending order: sorting numbers is faster than sorting places by them."""
    low = np.uint64((1 << 20) - 1)
    if len(token) <= int(low):
        order = (np.sort(token & ~low | np.arange(len(token), dtype=np.uint64)) & low).astype(np.int64)
        ranked = token[order]
        if (ranked[1:] >= ranked[:-1]).all():  # else two differ in the lower bits only
            return order
    return np.argsort(token)


def _sorted(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both by row, then value; neither is as large as 2^31."""
    key = np.sort(row << 32 | value)
    return key >> 32, key & 0xFFFFFFFF


def bitmaps(lines: Lines) -> list[np.ndarray]:
    """Four words for each line: each bit tells whether the number of its tokens is odd.

    A token in one of two sets changes one bit. Narrow bitmaps are wide ones whose words
    are added up (without carry), and so are differences of them.
    """
    none, out = np.uint64(0), [np.zeros(len(lines.size), np.uint64) for _ in range(4)]
    if not len(lines.size):
        return out
    value = mixed(lines.known)
    bit = np.left_shift(np.uint64(1), value >> np.uint64(58))[lines.id]
    out[0] = np.bitwise_xor.reduceat(bit, lines.first)
    wide = np.flatnonzero(lines.size >= TWO)  # all others have one word
    if len(wide):
        size = lines.size[wide]
        first, at = np.cumsum(size) - size, np.flatnonzero((lines.size >= TWO)[lines.row])
        word = (value >> np.uint64(56))[lines.id[at]] & np.repeat(np.where(size >= FOUR, 3, 1).astype(np.uint64), size)
        bit = bit[at]
        for k in range(4):
            out[k][wide] = np.bitwise_xor.reduceat(np.where(word == np.uint64(k), bit, none), first)
    return out


def _bucket(token: np.ndarray) -> np.ndarray:
    return (token & np.uint64(BUCKETS - 1)).astype(np.int64)


def _marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _read(batch: pa.RecordBatch, text: str) -> Iterator[Lines]:
    """The lines of a batch of texts, or of packed pieces in ``lines``."""
    if "lines" in batch.schema.names:
        for blob in batch.column("lines"):
            yield Lines.unpacked(blob.as_py())
        free_memory()
        return
    for part in pieces(batch, text, PIECE):
        yield Lines(part.column(text), part.column("doc_id").to_numpy(zero_copy_only=False))


def sets_and_counts(docs: DataFrame, text: str) -> DataFrame:
    """One pass: a row ``(doc, line, k1, k2, n)`` for each line with words, the lines of each piece and a task's counts.

    Lines are packed in ``lines``, so that texts are cut only here. Counts are rows with the
    range of buckets in ``line`` and the counts, packed, in ``counts``.
    """
    names = ["doc", "line", "k1", "k2", "n", "counts", "lines"]
    width = BUCKETS // COUNTED

    def rows(n_rows: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n_rows, pa.binary() if c in names[5:] else pa.int64())) for c in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            for part in pieces(batch, text, STORED):
                lines = Lines(part.column(text), part.column("doc_id").to_numpy(zero_copy_only=False))
                if not len(lines.id):
                    continue
                np.add.at(total, _bucket(lines.known), np.bincount(lines.id, minlength=len(lines.known)).astype(np.int32))
                k1, k2 = lines.keys()
                yield rows(len(k1), doc=pa.array(lines.doc), line=pa.array(lines.line), k1=pa.array(k1), k2=pa.array(k2), n=pa.array(lines.size))
                yield rows(1, lines=pa.array([lines.packed()], pa.binary()))
        if total.any():
            blobs = [zstandard.compress(planes(total[k : k + width]), 1) for k in range(0, BUCKETS, width)]
            del total
            yield rows(COUNTED, line=pa.array(np.arange(COUNTED)), counts=pa.array(blobs, pa.binary()))
        free_memory()

    return docs.mapInArrow(run, "doc long, line long, k1 long, k2 long, n long, counts binary, lines binary")


def rarity(told: DataFrame) -> np.ndarray:
    """Lines per token bucket over all texts: one array of fixed size."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS // COUNTED, np.int64)
        for blob in table["counts"]:
            total += unplanes(zstandard.decompress(blob.as_py()), np.int32)
        packed = zstandard.compress(planes(np.minimum(total, 2**31 - 1).astype(np.int32)), 1)
        return pa.table({"line": table["line"][:1], "counts": pa.array([packed], pa.binary())})

    rows = told.filter("counts IS NOT NULL").select("line", "counts").groupBy("line").applyInArrow(add, "line long, counts binary").collect()
    out = np.zeros((COUNTED, BUCKETS // COUNTED), np.int32)
    for r in rows:
        out[r.line] = unplanes(zstandard.decompress(r.counts), np.int32)
    return out.ravel()


BITS = ["b0", "b1", "b2", "b3"]
COLUMNS = ["tok", "doc", "line", "np", *BITS]
ENTRY = ", ".join(f"{c} long" for c in COLUMNS)


def postings(docs: DataFrame, text: str, rare: Broadcast, least: Fraction, asked: Broadcast | None = None, copies: bool = False, plain: bool = False, among: Broadcast | None = None) -> DataFrame:
    """``(part, blob)``: packed runs of the prefix tokens of every line, by range of the token.

    An entry has the token, the line's document and number, its size and the place of
    the token in it, and a bitmap of all its tokens. ``docs`` are texts or packed lines.

    A token that no other line has is left out: it makes no pair. So are those of buckets
    not marked in the bits of ``asked``, and lines not marked in those of ``among``.
    With ``plain`` rows are single entries, by ``COLUMNS``: few are asked for then.

    Within a piece of the input a set is given once, by its first line, except with
    ``copies``. Lines too short to be similar to any other set have none.
    """
    a, b = least.numerator, least.denominator

    def make(lines: Lines):
        if among is not None:
            lines = lines.only(_marked(among.value, _mark(lines.doc, lines.line)))
        count = np.minimum(rare.value[_bucket(lines.known)], 65_535).astype(np.uint16)
        serves = count > 1
        if asked is not None:
            serves &= _marked(asked.value, _bucket(lines.known))
            has = np.zeros(len(lines.size), bool)
            has[lines.row[serves[lines.id]]] = True
            lines = lines.only(has)
        use = np.ones(len(lines.size), bool)
        if not copies:
            k1, k2 = lines.keys()
            order = np.lexsort((lines.line, lines.doc, k2, k1))
            use[order] = _changes(k1[order]) | _changes(k2[order])
        n = lines.size
        use &= (a * (n + 1) <= b * n) | (a * n <= b * (n - 1))  # a set one larger or one smaller may be similar
        lines = lines.only(use)
        n = lines.size
        by = np.argsort(count, kind="stable")  # rare ones first, those above 65,534 alike, then by token
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        row, place = _sorted(lines.row, rank[lines.id])
        id_ = by[place]
        pos = np.arange(len(row)) - lines.first[row]
        length = n - (a * n + b - 1) // b + 1
        keep = (pos < length[row]) & serves[id_]
        row = row[keep]
        columns = [lines.known[id_[keep]], lines.doc[row], lines.line[row], n[row] << 32 | pos[keep], *(x[row] for x in bitmaps(lines))]
        return [pa.array(x.view(np.int64)) for x in columns] if plain else columns

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _read(batch, text):
                yield pa.RecordBatch.from_arrays(make(lines), COLUMNS)

    def packed(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        """Entries of some pieces, in runs by range."""
        token, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
        by = np.argsort(token, kind="stable")
        token, columns = token[by], [c[by] for c in columns]
        part = ranges(token, n_parts)
        cuts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)])) if len(part) else np.zeros(1, np.int64)
        blobs = [
            zstandard.compress(b"".join([planes(np.diff(token[x:y], prepend=np.uint64(0))), *(planes(np.ascontiguousarray(c[x:y])) for c in columns)]), 1)
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), pa.array(blobs, pa.binary())], ["part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for lines in _read(batch, text):
                held.append(make(lines))
                n += len(held[-1][0])
                if n >= PACKED:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    n_parts = 2 * max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return docs.mapInArrow(single, ENTRY) if plain else docs.mapInArrow(run, "part long, blob binary")


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    """Entries of a run, tokens ascending."""
    raw = zstandard.decompress(blob)
    n = len(raw) // (8 * len(COLUMNS))
    out = {c: unplanes(raw[8 * n * k : 8 * n * (k + 1)], np.uint64) for k, c in enumerate(COLUMNS)}
    out["tok"] = np.cumsum(out["tok"], dtype=np.uint64)
    return {c: v.view(np.int64) for c, v in out.items()}


def count_bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def _candidates(most: int, least: Fraction, only: bool):
    """Pairs of lines of one token, rows sorted by (tok, np): at most ``most`` for each later line.

    ``off`` is the share of bits, of 1,000, by which they may differ that do. ``more`` tells that a later line had more of them. With ``only``, all pairs are
    given, but only for later lines marked ``open``.
    """
    a, b = least.numerator, least.denominator
    names = COLUMNS + ["open"] * only

    def pairs(c: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        n, pos, tok = c["np"] >> 32, c["np"] & 0xFFFFFFFF, c["tok"]
        new = np.ones(len(tok), bool)
        new[1:] = tok[1:] != tok[:-1]
        group = np.cumsum(new) << 32
        folded = c["b0"] ^ c["b1"] ^ c["b2"] ^ c["b3"]
        low = np.searchsorted(group + n, group + (a * n + b - 1) // b)
        count = np.arange(len(n)) - low
        ends = np.cumsum(count)
        at = 0
        while at < len(n):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
            size = count[at:to]
            i = np.repeat(np.arange(at, to), size)
            j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[at:to], size)
            at = to
            both = n[i] + n[j]
            need = (a * both + a + b - 1) // (a + b)
            ok = np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need
            i, j, both, need = i[ok], j[ok], both[ok], need[ok]
            most_off, least_n = both - 2 * need, np.minimum(n[i], n[j])
            off = count_bits(folded[i] ^ folded[j])
            ok = off <= most_off
            i, j, off, most_off, least_n = i[ok], j[ok], off[ok], most_off[ok], least_n[ok]
            for size in (TWO, FOUR):
                wide = np.flatnonzero(least_n >= size)
                p, q = i[wide], j[wide]
                d = [c[x][p] ^ c[x][q] for x in BITS]
                d = [d[0] ^ d[2], d[1] ^ d[3]] if size == TWO else d
                off[wide] = sum(count_bits(x) for x in d)
                ok = off <= most_off
                i, j, off, most_off, least_n = i[ok], j[ok], off[ok], most_off[ok], least_n[ok]
            share = 1000 * off // np.maximum(most_off, 1)
            later = (c["doc"][i] > c["doc"][j]) | ((c["doc"][i] == c["doc"][j]) & (c["line"][i] > c["line"][j]))
            x, y = np.where(later, i, j), np.where(later, j, i)
            if only:
                ok = c["open"][x]
                x, y, share = x[ok], y[ok], share[ok]
                more = np.zeros(len(x), bool)
            else:
                order = np.lexsort((y, off, x))
                x, y, share = x[order], y[order], share[order]
                opens = np.ones(len(x), bool)
                opens[1:] = x[1:] != x[:-1]
                first = np.flatnonzero(opens)
                number = np.diff(np.concatenate((first, [len(x)])))
                place = np.arange(len(x)) - np.repeat(first, number)
                # A partner whose bitmap is far closer than it must be most likely matches: two such do.
                sure = 3 * off[order][first] <= most_off[order][first]
                limit = np.where(sure, 2, most)
                more = np.repeat(number > limit, number)
                keep = place < np.repeat(limit, number)
                x, y, share, more = x[keep], y[keep], share[keep], more[keep]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (c["doc"][x], c["line"][x], c["doc"][y], c["line"][y], share, more)], ["xd", "xl", "yd", "yl", "off", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            if held:
                now = {k: np.concatenate((held[k], now[k])) for k in names}
            cut = int(np.searchsorted(now["tok"], now["tok"][-1]))
            held = {k: v[cut:] for k, v in now.items()}
            if cut:
                yield from pairs({k: v[:cut] for k, v in now.items()})
        if held:
            yield from pairs(held)

    def combine(table: pa.Table) -> pa.Table:
        """All entries of a range of tokens: a share of the tokens, not of the rows of one."""
        all_ = [unpacked(x.as_py()) for x in table["blob"]]
        c = {k: np.concatenate([e.pop(k) for e in all_]) for k in COLUMNS}  # no column is held twice
        order = np.lexsort((c["np"], c["tok"]))
        for k in COLUMNS:
            c[k] = c[k][order]
        found = pa.Table.from_batches(list(pairs(c)))
        del c, order, all_
        free_memory()
        return found

    return run if only else combine


PAIR = "xd long, xl long, yd long, yl long, off long, more boolean"


#: Words of the wide bitmap of a set.
WIDE = [f"m{k}_" for k in range(8)]


def _mark(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The bit of a line in the table of marks."""
    both = mixed(doc.astype(np.int64).view(np.uint64)) + line.astype(np.int64).view(np.uint64)
    return (mixed(both) >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)


def _marks(pairs: DataFrame) -> np.ndarray:
    """The bits of all lines of pairs: one table of fixed size."""

    def places(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([_mark(batch.column(doc).to_numpy(), batch.column(line).to_numpy()) for doc, line in (("xd", "xl"), ("yd", "yl"))])

    return bit_table(pairs.select("xd", "xl", "yd", "yl"), places, MARKS)


def _sets(rows: DataFrame, marks: Broadcast, wide: list[str]) -> DataFrame:
    """``(doc, line, t, n, *wide)``: token sets of the lines that are marked, their sizes and wide bitmaps.

    Other lines may have the bit of a marked one: joins with the pairs leave them out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _read(batch, "text"):
                found = lines.only(_marked(marks.value, _mark(lines.doc, lines.line)))
                token = found.token
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate((found.first, [len(token)])).astype(np.int32)), pa.array(token.view(np.int64)))
                columns = [pa.array(found.doc), pa.array(found.line), lists, pa.array(found.size)]
                if wide:
                    bit = (mixed(token) >> np.uint64(55)).astype(np.int64)
                    maps = np.zeros((len(found.first), len(wide)), np.uint64)
                    np.bitwise_or.at(maps, (found.row, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
                    columns += [pa.array(maps[:, k].view(np.int64)) for k in range(len(wide))]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "line", "t", "n"] + wide)

    return rows.mapInArrow(cut, "doc long, line long, t array<long>, n long" + "".join(f", {x} long" for x in wide))


def _confirmed(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """``(xd, xl, more, good)`` for each pair, by its whole sets."""
    dealt = sets.select("doc", "line", "t").repartition("doc", "line")  # once for both sides
    x = dealt.select(F.col("doc").alias("xd"), F.col("line").alias("xl"), F.col("t").alias("s"))
    y = dealt.select(F.col("doc").alias("yd"), F.col("line").alias("yl"), "t")
    both = pairs.join(x, ["xd", "xl"]).join(y, ["yd", "yl"])
    same = F.size(F.array_intersect("s", "t"))
    good = same * least.denominator >= (F.size("s") + F.size("t") - same) * least.numerator
    return both.select("xd", "xl", "more", good.alias("good"))


def _similar(pairs: DataFrame, rows: DataFrame, least: Fraction, scratch: Scratch, guess: bool) -> DataFrame:
    """Later lines ``(doc, line, more, good)``: whether one of its pairs is confirmed on whole sets.

    With ``guess`` the likeliest partner of each line is compared first, all others of the lines that it does not confirm then.
    """
    context = rows.sparkSession.sparkContext
    pairs = scratch.written(pairs.groupBy("xd", "xl", "yd", "yl").agg(F.max("more").alias("more"), F.min("off").alias("off")))
    told, rest = None, pairs.drop("off")
    if guess:
        likely = pairs.groupBy("xd", "xl").agg(F.max("more").alias("more"), F.min(F.struct("off", "yd", "yl")).alias("y"))
        likely = scratch.written(likely.select("xd", "xl", "y.yd", "y.yl", "more"))
        marks = context.broadcast(_marks(likely))
        told = scratch.written(_confirmed(likely, _sets(rows, marks, []), least))
        marks.destroy()
        rest = rest.join(told.filter("NOT good").select("xd", "xl"), ["xd", "xl"], "left_semi")
        rest = scratch.written(rest.join(likely, ["xd", "xl", "yd", "yl"], "left_anti"))
    marks = context.broadcast(_marks(rest))
    sets = scratch.written(_sets(rows, marks, WIDE))
    marks.destroy()
    # Wide bitmaps first: they are small and rule most pairs out.
    slim = sets.drop("t")
    other = slim.withColumnsRenamed({"doc": "yd", "line": "yl", "n": "n2"} | {x: f"{x}2" for x in WIDE})
    a, b = least.numerator, least.denominator
    need = f"(({a} * (n + n2) + {a + b - 1}) div {a + b})"
    differ = " + ".join(f"bit_count({x} ^ {x}2)" for x in WIDE)
    can = rest.join(slim.withColumnsRenamed({"doc": "xd", "line": "xl"}), ["xd", "xl"]).join(other, ["yd", "yl"])
    can = scratch.written(can.filter(f"{differ} <= n + n2 - 2 * {need}").select("xd", "xl", "yd", "yl", "more"))
    found = _confirmed(can, sets, least)
    told = told.union(found) if guess else found
    return told.groupBy(F.col("xd").alias("doc"), F.col("xl").alias("line")).agg(F.max("more").alias("more"), F.max("good").alias("good"))


def _gone(rows: DataFrame, least: Fraction, most: int) -> DataFrame:
    """``(doc_id, gone)``: numbers of the lines of ``rows(doc_id, text)`` to be removed, stored."""
    spark = rows.sparkSession
    scratch = Scratch(spark)
    told = scratch.written(sets_and_counts(rows, "text"))
    rare = spark.sparkContext.broadcast(np.minimum(rarity(told), 65_535).astype(np.uint16))  # BUCKETS numbers, larger ones are alike
    lines = told.filter("doc IS NOT NULL")
    sets = told.filter("lines IS NOT NULL").select("lines")
    firsts = scratch.written(lines.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc", "line")).alias("f")).select("k1", "k2", "n", "f.doc", "f.line"))

    posted = postings(sets, "text", rare, least)
    found = posted.groupBy("part").applyInArrow(_candidates(most, least, False), PAIR)
    first = scratch.written(_similar(found, sets, least, scratch, True))
    again = scratch.written(first.filter("more AND NOT good").select("doc", "line"))
    repeated = first.filter("good").select("doc", "line")
    if not again.isEmpty():
        among = spark.sparkContext.broadcast(_marks(again.selectExpr("doc AS xd", "line AS xl", "doc AS yd", "line AS yl")))
        own = postings(sets, "text", rare, least, copies=True, plain=True, among=among).join(again, ["doc", "line"])
        size = F.expr("np >> 32")
        asked = scratch.written(own.groupBy("tok").agg(F.min(size).alias("lo"), F.max(size).alias("hi")))
        a, b = least.numerator, least.denominator
        bucket = F.col("tok").bitwiseAND(BUCKETS - 1)
        marks = np.zeros(BUCKETS >> 3, np.uint8)
        bits = F.bit_or(F.expr("shiftleft(1L, cast(tok & 63 as int))"))
        for r in asked.groupBy(F.shiftright(bucket, 6).alias("at")).agg(bits.alias("bits")).collect():  # a row for 64 buckets
            marks[8 * r["at"] : 8 * r["at"] + 8] = np.frombuffer(np.int64(r["bits"]).tobytes(), np.uint8)
        entries = postings(sets, "text", rare, least, spark.sparkContext.broadcast(marks), plain=True)  # a bit for each bucket
        # Of the lines of these tokens only those whose sizes allow the similarity.
        entries = entries.join(asked, "tok").filter((size * b >= F.col("lo") * a) & (size * a <= F.col("hi") * b)).drop("lo", "hi")
        marked = entries.join(again.withColumn("open", F.lit(True)), ["doc", "line"], "left")
        marked = marked.withColumn("open", F.coalesce("open", F.lit(False)))
        rest = marked.repartition("tok").sortWithinPartitions("tok", "np").mapInArrow(_candidates(most, least, True), PAIR)
        repeated = repeated.union(_similar(rest, sets, least, scratch, False).filter("good").select("doc", "line"))

    known = firsts.join(repeated.withColumn("again", F.lit(True)), ["doc", "line"], "left")
    known = known.select("k1", "k2", "n", F.struct("doc", "line").alias("f"), F.coalesce("again", F.lit(False)).alias("again"))
    gone = lines.join(known, ["k1", "k2", "n"]).filter("again OR struct(doc, line) <> f")
    gone = written(gone.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_set("line").alias("gone")))  # no more than the lines of a document
    scratch.drop()
    rare.destroy()
    return gone


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with compressed texts: they are exchanged so."""
    kept = docs.schema.fields

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in pieces(batch, text):
                texts = [None if t is None else z.compress(t) for t in part.column(text).cast(pa.binary()).to_pylist()]
                columns = [pa.array(texts, pa.binary()) if c == text else part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)
        free_memory()

    return docs.mapInArrow(pack, ", ".join(f"`{f.name}` {'binary' if f.name == text else f.dataType.simpleString()}" for f in kept))


def dedup_lines(docs: DataFrame, text: str = "text", similarity: str = "0.8", most: int = 64) -> DataFrame:
    """``docs`` with ``text`` reduced to the lines kept, ``n_lines`` and ``n_removed``.

    A line is removed if an earlier line (smaller doc_id, or earlier in the same
    document) has a token set with a Jaccard similarity of ``similarity`` or more;
    lines are judged on the input, not on what is left. Tokens are the distinct words
    between ASCII white space, A-Z in lower case. Lines without words stay. Lines end
    at line feeds; a null text stays null, with no lines. doc_id must be unique and
    not null for rows to be told apart; rows that share one are compared as if the
    later lines of either came after the equally numbered of the other. Columns of
    ``docs`` named ``n_lines`` or ``n_removed`` are replaced.

    A later line is first compared with its likeliest partners, two very likely ones or
    else ``most`` for each token; lines that had more and matched none are then
    compared with all of theirs.

    The session keeps small Arrow batches, as the rows returned are made by Python too.
    """
    least = Fraction(similarity)
    rows = docs.select("doc_id", F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    kept = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_removed")]
    own = {f.name.lower() for f in docs.schema.fields}
    out = next(name for k in range(len(own) + 1) if (name := f"gone{k}") not in own)
    lean_batches(docs.sparkSession)
    gone = _gone(rows, least, most).withColumnRenamed("gone", out)
    whole = _packed(docs.select([f.name for f in kept]), text)
    joined = whole.join(gone.hint("merge"), "doc_id", "left")  # else a task packs and unpacks at once, in two Python workers

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b, text, 1 << 20)):
            left_over, n_lines, n_removed, opened = [], [], [], zstandard.ZstdDecompressor()
            for z, g in zip(batch.column(text).to_pylist(), batch.column(out).to_pylist(), strict=True):
                t = None if z is None else opened.decompress(z)
                n_lines.append(t.count(b"\n") + 1 if t else 0)
                n_left = n_lines[-1]
                if g and t:  # of rows that share a doc_id one may have fewer lines
                    g = set(g)
                    left = [x for k, x in enumerate(t.split(b"\n")) if k not in g]
                    t, n_left = b"\n".join(left), len(left)
                n_removed.append(n_lines[-1] - n_left)
                left_over.append(t)
            columns = [pa.array(left_over, pa.binary()).cast(pa.string()) if f.name == text else batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], [f.name for f in kept] + ["n_lines", "n_removed"])
        free_memory()

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_lines long", "n_removed long"])
    return joined.mapInArrow(drop, schema)
