"""Benchmark passages in documents: q-gram counting in diagonal bands, then banded alignment.

A passage of m bytes that stands in a text with at most k edits shares at least
``m + 1 - q - k * q`` of its q-grams with it, all on diagonals at most k apart. Shared
q-grams are counted in overlapping bands of diagonals; bands that reach the bound are
regions, and each is verified by an alignment of k diagonals to either side.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import flat, pieces, prefix_sums, rolling, span_hashes

_FILTER = 1 << 24


def normal(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ASCII letters in lower case, each run of white space one blank; the starts, and where each byte was."""
    low = data.copy()
    upper = (low >= 65) & (low <= 90)
    low[upper] += 32
    space = (low == 32) | ((low >= 9) & (low <= 13))
    low[space] = 32
    keep = np.ones(len(low), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    cut = starts[starts < len(low)]
    keep[cut] = True
    place = np.flatnonzero(keep)
    return low[place], np.searchsorted(place, starts), place


class Items:
    """The q-grams of a block of benchmark items, ready to be found in texts."""

    def __init__(self, ids: list[int], texts: list[bytes], q: int, rate: Fraction):
        self.ids, self.texts, self.q = np.array(ids, np.int64), texts, q
        size = np.array([len(t) for t in texts], np.int64)
        self.edits = size * rate.numerator // rate.denominator
        # The bound must be positive: a shorter passage gets a smaller budget.
        self.edits = np.maximum(0, np.minimum(self.edits, (size - q) // q))
        self.bound = size + 1 - q - self.edits * q
        self.size = size
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate(([0], np.cumsum(size)))
        at = np.concatenate([np.arange(a, b - q + 1) for a, b in zip(starts[:-1], starts[1:], strict=True)] + [np.zeros(0, np.int64)]).astype(np.int64)
        item = np.searchsorted(starts, at, "right") - 1
        gram = span_hashes(prefix_sums(data), at, at + q) if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(gram, kind="stable")
        self.gram, self.item, self.at = gram[order], item[order], (at - starts[item])[order]
        self.filter = np.zeros(_FILTER, bool)
        self.filter[(self.gram & np.uint64(_FILTER - 1)).astype(np.int64)] = True
        self.distinct, self.first, self.number = np.unique(self.gram, return_index=True, return_counts=True)

    def hits(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in ``data``, item and place in the item of every shared q-gram within a text."""
        q = self.q
        n = len(data) - q + 1
        none = np.zeros(0, np.int64)
        if n <= 0 or not len(self.distinct):
            return none, none, none
        gram = rolling(data, q)
        some = np.flatnonzero(self.filter[(gram & np.uint64(_FILTER - 1)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.distinct, gram[some]), len(self.distinct) - 1)
        ok = self.distinct[k] == gram[some]
        some, k = some[ok], k[ok]
        inside = np.searchsorted(starts, some, "right") == np.searchsorted(starts, some + q - 1, "right")
        some, k = some[inside], k[inside]
        number = self.number[k]
        ends = np.cumsum(number)
        row = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[k] - ends + number, number)
        return np.repeat(some, number), self.item[row], self.at[row]

    def regions(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, item, diagonal)`` of the bands that reach the bound; a band starts at the diagonal.

        A band is 2 (k + 1) diagonals wide and the next one starts k + 1 further: any
        k + 1 neighbouring diagonals lie whole in one of them.
        """
        place, item, at = self.hits(data, starts)
        text = np.searchsorted(starts, place, "right") - 1
        width = self.edits[item] + 1
        # A text and an item that share too few q-grams in all can't reach it in a band.
        pair = text * len(self.ids) + item
        distinct, back, number = np.unique(pair, return_inverse=True, return_counts=True)
        ok = (number >= self.bound[distinct % max(1, len(self.ids))])[back]
        place, item, at, text, width = place[ok], item[ok], at[ok], text[ok], width[ok]
        diagonal = place - starts[text] - at + self.size[item]
        band = diagonal // width
        key = np.concatenate((band, band - 1))
        text2, item2, at2 = np.tile(text, 2), np.tile(item, 2), np.tile(at, 2)
        # Each q-gram of the item counts once in a band.
        order = np.lexsort((at2, key, item2, text2))
        key, text2, item2, at2 = key[order], text2[order], item2[order], at2[order]
        same = np.zeros(len(key), bool)
        same[1:] = (key[1:] == key[:-1]) & (text2[1:] == text2[:-1]) & (item2[1:] == item2[:-1])
        again = np.zeros(len(key), bool)
        again[1:] = same[1:] & (at2[1:] == at2[:-1])
        region = np.cumsum(~same) - 1
        count = np.bincount(region, weights=~again).astype(np.int64) if len(region) else np.zeros(0, np.int64)
        first = np.flatnonzero(~same)
        good = first[count >= self.bound[item2[first]]]
        return text2[good], item2[good], key[good] * (self.edits[item2[good]] + 1) - self.size[item2[good]]

    def align(self, text: bytes, item: int, diagonal: int) -> tuple[int, int, int] | None:
        """Edits, start and end of the best place of the item on the band's diagonals; None beyond the budget.

        Row by row over the item, one vector over the diagonals; the place may start
        and end on any diagonal of the band and k further to either side.
        """
        k, m, word = int(self.edits[item]), int(self.size[item]), self.texts[item]
        low, width = diagonal - k, 4 * k + 2
        exact = text.find(word, max(0, low), max(0, low + width + m))
        if exact >= 0:
            return 0, exact, exact + m
        if not k:
            return None
        far = k + 1
        span = np.full(width + m + 1, 256, np.int16)
        a, b = max(0, low), min(len(text), low + width + m)
        if a < b:
            span[a - low : b - low] = np.frombuffer(text[a:b], np.uint8)
        letters = np.frombuffer(word, np.uint8)
        slots = np.arange(width)
        valid = (slots + low >= 0) & (slots + low <= len(text))
        cost = np.where(valid, 0, far)
        start = slots + low
        for i in range(m):
            put = cost + (span[i : i + width] != letters[i])
            leave = np.concatenate((cost[1:], [far])) + 1
            source = np.where(leave < put, np.concatenate((start[1:], [0])), start)
            best = np.minimum(put, leave)
            # Extra text bytes: from a diagonal to the left, one edit each.
            run = np.minimum.accumulate(best - slots) + slots
            moved = run < best
            if moved.any():
                origin = np.maximum.accumulate(np.where(best - slots == np.minimum.accumulate(best - slots), slots, 0))
                source = np.where(moved, source[origin], source)
                best = run
            best = np.minimum(best, far)
            ends = slots + low + i + 1
            cost = np.where((ends >= 0) & (ends <= len(text)), best, far)
            start = source
            if cost.min() > k:
                return None
        j = int(cost.argmin())
        return int(cost[j]), int(start[j]), j + low + m


def passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", q: int = 8, rate: str = "0.1", block_bytes: int = 4 << 20) -> DataFrame:
    """``(doc_id, item_id, edits, start, end)``: where benchmark items stand in whole documents.

    Texts are compared in UTF-8 with A-Z in lower case and each run of white space as
    one blank; ``start`` and ``end`` are byte positions in the text as given. An item
    matches with at most ``rate`` of its bytes edited (fewer for items so short that
    the q-gram bound would vanish: an item of less than 2 q bytes must stand exactly).
    Items with less than q bytes are skipped, as are null texts. There is one row for
    each band of diagonals that holds a match, none for documents without.

    The items go to the tasks in blocks of at most ``block_bytes`` of text (and one
    item more), one pass over the documents for each block; rows of documents stay
    where they are.
    """
    ratio = Fraction(rate)
    spark = docs.sparkSession
    found = None
    for ids, texts in _blocks(benchmark, q, block_bytes):
        shared = spark.sparkContext.broadcast((ids, texts))  # at most block_bytes and one item

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value, q, ratio)
            for batch in batches:
                for part in pieces(batch, text):
                    data, starts, place = normal(*flat(part.column(text)))
                    raw = flat(part.column(text))[1]
                    rows: dict[tuple[int, int, int, int], int] = {}
                    whole = data.tobytes()
                    for d, item, diagonal in zip(*(x.tolist() for x in items.regions(data, starts)), strict=True):
                        a, b = int(starts[d]), int(starts[d + 1])
                        hit = items.align(whole[a:b], item, diagonal)
                        if hit:
                            key = (d, item, int(place[a + hit[1]] - raw[d]), int(place[a + hit[2] - 1] + 1 - raw[d]))
                            rows[key] = min(hit[0], rows.get(key, hit[0]))
                    ids = part.column("doc_id").to_pylist()
                    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[d] for d in columns[0]], pa.int64()),
                            pa.array([int(items.ids[i]) for i in columns[1]], pa.int64()),
                            pa.array(list(rows.values()), pa.int64()),
                            pa.array(columns[2], pa.int64()),
                            pa.array(columns[3], pa.int64()),
                        ],
                        ["doc_id", "item_id", "edits", "start", "end"],
                    )

        part = docs.select("doc_id", text).mapInArrow(run, "doc_id long, item_id long, edits long, start long, end long")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, edits long, start long, end long")
    return found


def _blocks(benchmark: DataFrame, q: int, block_bytes: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Normalised items, block by block; the driver holds one partition of items and one block."""
    ids, texts, size = [], [], 0
    for r in benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        data, _, _ = normal(*flat(pa.array([r["text"]])))
        word = data.tobytes().strip(b" ")
        if len(word) < q:
            continue
        ids.append(r["item_id"])
        texts.append(word)
        size += len(word)
        if size >= block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def leaked(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``leaks``: the items found in each, ascending; empty if none.

    A column of ``docs`` named ``leaks`` is replaced. doc_id should be unique; rows
    that share one share their leaks. A null doc_id has none.
    """
    found = passages(docs.select("doc_id", text), benchmark, text, **options)
    lists = found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("leaks"))
    kept = [f.name for f in docs.schema.fields if f.name != "leaks"]
    return docs.select(kept).join(lists, "doc_id", "left").select(*kept, F.coalesce("leaks", F.array().cast("array<bigint>")).alias("leaks"))
