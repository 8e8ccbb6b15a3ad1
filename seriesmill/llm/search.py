"""Exact top-k search by BM25: inverted index per shard, block-max pruning, exact merge."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.common import bit_table, flat, lowered, MARKS, pieces, planes, prefix_sums, span_hashes, unplanes, word_spans, WORD_BREAK, written

#: Terms with a row of their own in a shard: at most so many, in over one of so many documents.
MOST_ROWS, LEAST_SHARE = 1_024, 32
#: A document's whole numbers in these rows add up to less.
SUMS = 1 << 12
#: Documents with fewer of these terms, on average, share numbers.
SHARED = 128
#: Lists of so many postings are taken one by one, shorter ones together; postings whose impacts are worked out at once.
LONG, STEP = 24, 1 << 20
#: Documents whose terms are looked through at once.
STEP_DOCS = 1 << 12
#: Terms by which similar documents are found, and the share of all variance that an axis has which parts them.
ORDER_TERMS, AXIS = 128, 0.1
#: Shards, and terms of documents, held before they are searched; terms and documents of a shard at most.
HELD, HELD_TERMS, SHARD_TERMS, MOST_DOCS = 3, 1 << 24, 1 << 22, 1 << 16
#: Queries whose bounds are unpacked, and documents scored exactly, at once.
OPEN_ROWS, EXACT_DOCS = 32, 1_024
#: Sums of postings, of some queries, worked out at once.
SUMMED = 1 << 14
#: Queries looked up at once.
ASKED = 512
#: What a row of a cell holds, in the order in which a task reads them.
FREQUENCIES, QUERIES, DOCUMENTS = range(3)
#: Scores have so many decimals: sums that differ by less are ties.
DECIMALS = 6


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text: hash, count and text, and the words of each text."""
    data, starts = flat(lowered(texts))
    begin, end, owner = word_spans(data, starts, WORD_BREAK)
    value = span_hashes(prefix_sums(data), begin, end)
    order = np.lexsort((value, owner))
    value, of = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    return value[first].view(np.int64), np.diff(np.concatenate((first, [len(value)]))), of[first], np.bincount(owner, minlength=len(texts))


#: Columns of packed term vectors: integers in planes, compressed.
PACKED = ("ids", "words", "sizes", "known", "often", "terms", "counts")
CHUNK = ", ".join(f"{c} binary" for c in PACKED)


def packed(**arrays: np.ndarray) -> list[pa.Array]:
    blobs = [zstandard.compress(planes(arrays[c]), 1) if len(arrays.get(c, ())) else b"" for c in PACKED]
    return [pa.array([blob], pa.binary()) for blob in blobs]


def unpacked(row: dict, name: str) -> np.ndarray:
    kind = np.int32 if name in ("terms", "counts") else np.int64
    return unplanes(zstandard.decompress(row[name]), kind) if row[name] else np.zeros(0, kind)


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value.view(np.uint64) >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)


def vectors(docs: DataFrame, text: str, marks: Broadcast | None = None) -> DataFrame:
    """Term vectors of whole texts, a row for some documents: ``(n, total, ids, words, sizes, known, often, terms, counts)``.

    ``n`` documents have words, ``total`` words in all. ``known`` are the distinct terms of
    these documents, ``often`` how many of them each is in; ``terms`` are differences of
    places in ``known``. With ``marks`` only terms whose bucket is marked are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                value, count, of, words = terms(part.column(text))
                if marks is not None:
                    at = _bucket(value)
                    asked = marks.value[at >> 3] >> (at & 7) & 1 > 0
                    value, count, of = value[asked], count[asked], of[asked]
                some = np.flatnonzero(words > 0)
                known, term, often = np.unique(value, return_inverse=True, return_counts=True)
                size = np.bincount(of, minlength=part.num_rows)[some]
                step = np.diff(term, prepend=0)
                first = np.flatnonzero(np.diff(of, prepend=-1))
                step[first] = term[first]
                ids = part.column(0).to_numpy()[some]
                columns = packed(ids=ids, words=words[some], sizes=size, known=known, often=often, terms=step.astype(np.int32), counts=count.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([len(some)]), pa.array([int(words.sum())]), *columns], ["n", "total", *PACKED])

    rows = docs.select("doc_id", text).filter("doc_id IS NOT NULL")
    return rows.mapInArrow(run, f"n long, total long, {CHUNK}").filter("n > 0")


def places(row: dict, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``known`` of the terms of a row of ``vectors``, their counts and the number of each document's; other terms are left out."""
    size, own = unpacked(row, "sizes"), unpacked(row, "known")
    ends = np.cumsum(size)
    sums = np.concatenate(([0], np.cumsum(unpacked(row, "terms"), dtype=np.int64)))
    term = sums[1:] - np.repeat(sums[ends - size], size)
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros_like(size)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    here = (known[at] == own)[term]
    owner = np.repeat(np.arange(len(size)), size)[here]
    return at[term[here]], unpacked(row, "counts")[here], np.bincount(owner, minlength=len(size))


class Shard:
    """Inverted index of some documents.

    The most frequent terms have a row each of a table: their impacts on all documents. Those
    of short documents are rounded up to whole numbers so small that two documents share a number
    and a matrix product adds both up at once. All other terms have lists of postings. Both give upper bounds of all
    scores; whole vectors with exact impacts serve the documents that may be among the best.
    """

    def __init__(self, ids, words, term, count, starts, known, df, n_docs: int, mean: float, k1: float, b: float, placed: bool = False):
        """With ``placed``, ``term`` are places in the ascending ``known``."""
        n = len(ids)
        if not placed:
            sort = np.argsort(known)
            known, df = known[sort], df[sort]
            term = np.searchsorted(known, term)
        self.known, self.starts, self.ids = known, starts, ids
        self.term, self.count, self.gain = term.astype(np.int32, copy=False), count, k1 + 1
        self.idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
        self.weight = k1 * (1 - b + b * words / mean)
        doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
        impact = np.empty(len(self.term), np.float32)
        for x in range(0, len(impact), STEP):
            own = slice(x, x + STEP)
            impact[own] = self.impacts(self.term[own], self.count[own], doc[own])
        often = np.bincount(self.term, minlength=len(known))
        frequent = np.flatnonzero(often > n / LEAST_SHARE)
        frequent = frequent[np.argsort(-often[frequent], kind="stable")[:MOST_ROWS]]
        # The terms that are here: those with rows come first, the others have their postings one after another.
        others = often > 0
        others[frequent] = False
        others = np.flatnonzero(others)
        self.slot = np.full(len(known), -1, np.int32)
        self.slot[frequent] = np.arange(len(frequent))
        self.slot[others] = np.arange(len(frequent), len(frequent) + len(others))
        row = self.slot[self.term]
        row[row >= len(frequent)] = -1
        at = np.flatnonzero(row >= 0)
        self._table(row[at], doc[at], impact[at], len(frequent), n)
        at = np.flatnonzero(row < 0)
        del row
        at = at[np.argsort(self.term[at], kind="stable")]
        # A number is a float, larger than the impact by 1.6 % at most, whose lower half is the document.
        self.post = (impact[at].view(np.uint32) + np.uint32(MOST_DOCS - 1) & ~np.uint32(MOST_DOCS - 1)) | doc[at].astype(np.uint32)
        del doc, impact, at
        self.post_starts = np.concatenate(([0], np.cumsum(often[others])))
        self.wanted = np.zeros(len(known), bool)

    def impacts(self, term: np.ndarray, count: np.ndarray, doc: np.ndarray) -> np.ndarray:
        impact = self.idf[term]
        impact *= count
        impact *= self.gain
        weight = self.weight[doc]
        weight += count
        impact /= weight
        return impact

    def _table(self, row: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_rows: int, n: int) -> None:
        """The table of frequent terms: column ``j`` has document ``j`` and, if they share it, 2^12 times document ``j + half``.

        A document's whole numbers add up to less than 2^12, so sums are exact in the 24 bits of a float.
        Documents with many of the terms would be rounded too much: they have a column each.
        """
        self.row_max = np.zeros(n_rows, np.float32)
        np.maximum.at(self.row_max, row, impact)
        self.shared = len(row) < SHARED * n
        self.half = half = -(-n // 2) if self.shared else n
        self.rows = np.zeros((n_rows, half), np.float32)
        if not self.shared:
            self.rows[row, doc] = impact
            return
        size, total = np.bincount(doc, minlength=n), np.bincount(doc, weights=impact, minlength=n)
        step = np.maximum(total / (SUMS - 2 - 2 * size), 1e-30).astype(np.float32)
        whole = np.ceil(impact / step[doc])
        whole += whole * step[doc] < impact  # quotients are rounded: no product may fall short of its impact
        for hi in (False, True):
            own = (doc >= half) == hi
            self.rows[row[own], doc[own] - half * hi] += whole[own] * np.float32(SUMS if hi else 1)
        self.low, self.high = step[:half], step[half:]

    def spread(self, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())

    def exact(self, docs: np.ndarray) -> np.ndarray:
        """Whole scores of documents for the terms marked in ``wanted``."""
        out = []
        for a in range(0, len(docs), EXACT_DOCS):
            own = docs[a : a + EXACT_DOCS]
            starts, ends = self.starts[own], self.starts[own + 1]
            hit = np.flatnonzero(self.wanted[np.concatenate([self.term[x:y] for x, y in zip(starts.tolist(), ends.tolist(), strict=True)])])
            past = np.cumsum(ends - starts)
            owner = np.searchsorted(past, hit, "right")
            at = hit + (ends - past)[owner]
            impact = self.impacts(self.term[at], self.count[at], own[owner])
            out.append(np.bincount(owner, weights=impact, minlength=len(own)))
        return np.round(np.concatenate(out), DECIMALS) if out else np.zeros(0)

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents for a set of terms (places in ``known``) and their scores."""
        _, docs, score = self.search_all(query, np.array([0, len(query)]), k, np.zeros(1))
        return docs, score

    def search_all(self, query: np.ndarray, cuts: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best documents for several sets of terms, between ``cuts``: set, document and score, k at most for each.

        Only documents that score ``floor`` at least are sought. Postings are added up first;
        a set that does not reach its floor with the best of these sums and all maxima of its
        rows is done. For all others rows are added: these are bounds of all documents.
        Those that can be among the best are scored exactly.
        """
        n, size = len(cuts) - 1, np.diff(cuts)
        keep = 1 - (size + 4) * 2.0**-23  # sums of so many rounded numbers are within this of each other
        least = np.maximum(np.where(floor > 0, floor * keep - 2 * 10.0**-DECIMALS, 0), 1e-30)
        slot = self.slot[query]
        here = np.flatnonzero(slot >= 0)
        slot, of = slot[here], np.repeat(np.arange(n), size)[here]
        rare = slot >= len(self.rows)
        bound = self.sums(slot[rare] - len(self.rows), of[rare], n)
        row, of = slot[~rare], of[~rare]
        reach = bound.max(1, initial=0) + np.bincount(of, weights=self.row_max[row], minlength=n) * (2 - keep)
        open_ = np.flatnonzero(reach >= least)
        at = np.full(n, -1)
        at[open_] = np.arange(len(open_))
        at = at[of]
        has = np.zeros((len(open_), len(self.rows)), np.float32)
        has[at[at >= 0], row[at >= 0]] = 1
        both = has @ self.rows
        found = []
        for a in range(0, len(open_), OPEN_ROWS):
            some = open_[a : a + OPEN_ROWS]
            now = bound[some]
            self.unpack(both[a : a + OPEN_ROWS], now)
            for j in np.flatnonzero(now.max(1) >= least[some]).tolist():
                i = some[j]
                docs = np.flatnonzero(now[j] >= least[i])
                own, score = self.best(query[cuts[i] : cuts[i + 1]], docs, now[j, docs], k, floor[i], keep[i])
                found.append((np.full(len(own), i), own, score))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def sums(self, term: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        """The postings of some terms, by place in ``post_starts``, added up in ``n`` rows, ``of`` which the terms are."""
        n_docs, starts = len(self.ids), self.post_starts[term]
        size = self.post_starts[term + 1] - starts
        long = size > LONG
        few = self.post[self.spread(starts[~long], size[~long])]
        total = np.bincount(of, weights=size, minlength=n).astype(np.int64)
        cuts = np.concatenate(([0], np.cumsum(np.bincount(of[~long], weights=size[~long], minlength=n)))).astype(np.int64).tolist()
        ends = np.searchsorted(of[long], np.arange(n + 1)).tolist()
        spans = list(zip(starts[long].tolist(), (starts + size)[long].tolist(), strict=True))
        out, post = np.empty((n, n_docs), np.float32), self.post
        step = max(1, SUMMED // max(1, n_docs))
        most = max((int(total[a : a + step].sum()) for a in range(0, n, step)), default=0)
        # Memory that is used again is not cleared each time.
        both, docs, impact = np.empty(most, np.uint32), np.empty(most, np.int64), np.empty(most, np.float64)
        for a in range(0, n, step):
            z, at = min(n, a + step), 0
            lists = []
            for i in range(a, z):
                lists.append(few[cuts[i] : cuts[i + 1]])
                lists += [post[x:y] for x, y in spans[ends[i] : ends[i + 1]]]
            m = int(total[a:z].sum())
            np.concatenate(lists, out=both[:m])
            np.bitwise_and(both[:m], np.uint32(MOST_DOCS - 1), out=docs[:m], casting="unsafe")
            for i in range(a, z):
                docs[at : at + total[i]] += (i - a) * n_docs
                at += total[i]
            impact[:m] = both[:m].view(np.float32)
            out[a:z] = np.bincount(docs[:m], weights=impact[:m], minlength=(z - a) * n_docs).reshape(z - a, n_docs)
        return out

    def unpack(self, both: np.ndarray, bound: np.ndarray) -> None:
        """Adds what products with the rows stand for; these are changed."""
        if not self.shared:
            bound += both
            return
        high = both * np.float32(1 / SUMS)
        np.floor(high, out=high)
        whole = high * np.float32(SUMS)
        both -= whole
        both *= self.low
        bound[:, : self.half] += both
        high = high[:, : bound.shape[1] - self.half]
        high *= self.high
        bound[:, self.half :] += high

    def best(self, query: np.ndarray, docs: np.ndarray, bound: np.ndarray, k: int, floor: float, keep: float) -> tuple[np.ndarray, np.ndarray]:
        """Of these documents, whose scores are at most ``bound``, the k best that score ``floor`` at least."""
        self.wanted[query] = True
        kept, score, step = np.zeros(0, np.int64), np.zeros(0), k + 4
        while len(docs):
            if len(docs) > step:
                part = np.argpartition(-bound, step - 1)
                now, rest = part[:step], part[step:]
            else:
                now, rest = np.arange(len(docs)), np.zeros(0, np.int64)
            kept, score = np.concatenate((kept, docs[now])), np.concatenate((score, self.exact(docs[now])))
            docs, bound, step = docs[rest], bound[rest], 2 * step
            good = np.lexsort((self.ids[kept], -score))[:k]
            good = good[score[good] >= floor]
            kept, score = kept[good], score[good]
            if len(kept) == k:
                rest = bound >= score[-1] * keep - 2 * 10.0**-DECIMALS
                docs, bound = docs[rest], bound[rest]
        self.wanted[query] = False
        some = score > 0
        return kept[some], score[some]


class Cell:
    """A block of queries that meets a group of documents, shard by shard.

    Carries the k best of each query, so that a later shard only looks for better ones.
    """

    def __init__(self, k: int, shard_docs: int, *collection: float):
        self.k, self.shard_docs, self.collection = k, shard_docs, collection
        self.stats, self.asked, self.held, self.n_held, self.n_terms = [], [], [], 0, 0
        self.of, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.known, self.together = None, False

    def add(self, kind: int, row: dict) -> None:
        """Takes a row: of frequencies, of queries or of documents; all of one kind before those of the next."""
        if kind == FREQUENCIES:
            self.stats.append((unpacked(row, "known"), unpacked(row, "often")))
            return
        if self.known is None:
            self.known, self.df = (np.concatenate(x) for x in zip(*self.stats, strict=True)) if self.stats else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            order = np.argsort(self.known)
            self.known, self.df, self.stats = self.known[order], self.df[order], []
        term, count, size = places(row, self.known)
        term = term.astype(np.int32)
        if kind == QUERIES:
            self.asked.append((unpacked(row, "ids"), term, size))
            return
        self.hold(unpacked(row, "ids"), unpacked(row, "words"), term, count, size)

    def hold(self, ids: np.ndarray, words: np.ndarray, term: np.ndarray, count: np.ndarray, size: np.ndarray) -> None:
        if not count.size or count.max() < 1 << 16:
            count = count.astype(np.uint16)
        self.held.append((ids, words, term, count, size))
        self.n_held += len(size)
        self.n_terms += len(term)
        if self.n_held >= HELD * self.shard_docs or self.n_terms >= HELD_TERMS:
            self.search()

    def search(self, last: bool = False) -> None:
        """Searches the documents held, similar ones together, and lets them go.

        Sets much smaller than a shard wait for more like them, if it isn't the ``last`` time.
        """
        if not self.together and self.asked:
            ids, query, size = _joined(self.asked)
            starts = np.concatenate(([0], np.cumsum(size)))
            order = np.concatenate(similar(query, starts, len(size), len(query)))
            query = np.concatenate([query[_terms_of(starts, order[a : a + STEP_DOCS])] for a in range(0, len(order), STEP_DOCS)])
            self.asked, self.together = [(ids[order], query, size[order])], True
        held, self.held, self.n_held, self.n_terms = self.held, [], 0, 0
        if not held or not self.asked:
            return
        ids, words, term, count, size = _joined(held)
        starts = np.concatenate(([0], np.cumsum(size)))
        sets = similar(term, starts, min(self.shard_docs, MOST_DOCS), SHARD_TERMS)
        by_size, wait = sorted(sets, key=len), []
        while not last and len(by_size) > 1 and 2 * len(by_size[0]) < self.shard_docs and 4 * size[by_size[0]].sum() < SHARD_TERMS and 3 * sum(map(len, [*wait, by_size[0]])) < len(size):
            wait.append(by_size.pop(0))
        for own in sets:
            if any(own is x for x in wait):
                continue
            at = _terms_of(starts, own)
            shard = Shard(ids[own], words[own], term[at], count[at], np.concatenate(([0], np.cumsum(size[own]))), self.known, self.df, *self.collection, placed=True)
            del at
            self.ask(shard)
            del shard
        for own in wait:
            at = _terms_of(starts, own)
            self.held.append((ids[own], words[own], term[at], count[at], size[own]))
            self.n_held += len(own)
            self.n_terms += len(at)

    def ask(self, shard: Shard) -> None:
        """All queries of one shard."""
        _, query, size = self.asked[0]
        cuts = np.concatenate(([0], np.cumsum(size)))
        starts = np.searchsorted(self.of, np.arange(len(size) + 1))
        floor = np.zeros(len(size))
        full = np.flatnonzero(np.diff(starts) >= self.k)
        floor[full] = self.score[starts[full] + self.k - 1]
        of, found, score = [self.of], [self.found], [self.score]
        for a in range(0, len(size), ASKED):
            z = min(len(size), a + ASKED)
            i, docs, exact = shard.search_all(query[cuts[a] : cuts[z]], cuts[a : z + 1] - cuts[a], self.k, floor[a:z])
            of.append(i + a)
            found.append(shard.ids[docs])
            score.append(exact)
        of, found, score = np.concatenate(of), np.concatenate(found), np.concatenate(score)
        order = np.lexsort((found, -score, of))
        of = of[order]
        best = np.arange(len(of)) - np.searchsorted(of, of) < self.k
        self.of, self.found, self.score = of[best], found[order][best], score[order][best]

    def best(self) -> list[pa.Array]:
        """Query, document and score of the k best, when all rows were added."""
        self.search(last=True)
        return [pa.array(self.asked[0][0][self.of] if self.asked else self.of), pa.array(self.found), pa.array(self.score)]


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The arrays of all parts, one after another. The parts are let go."""
    out = []
    for k in range(len(parts[0])):
        out.append(np.concatenate([x[k] for x in parts]))
        parts[:] = [(*x[:k], None, *x[k + 1 :]) for x in parts]
    return tuple(out)


def _terms_of(starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The places of all terms of some documents."""
    size = starts[docs + 1] - starts[docs]
    at = np.repeat(starts[docs] - np.cumsum(size) + size, size)
    at += np.arange(len(at))
    return at


def similar(term: np.ndarray, starts: np.ndarray, most: int, most_terms: int) -> list[np.ndarray]:
    """Documents in sets of at most ``most`` with ``most_terms`` or one, those with the same frequent terms together and long ones first.

    A set is cut at zero of the main axis of the presence of frequent terms if that stands
    out, as languages do. Else one that is too large is cut by the number of terms.
    """
    size = np.diff(starts)
    often = np.bincount(term)
    frequent = np.argsort(-often, kind="stable")[: 4 * ORDER_TERMS]
    row = np.full(len(often) + 1, -1, np.int16)
    row[frequent] = np.arange(len(frequent))
    all_ = np.zeros((len(size), len(frequent)), bool)
    for a in range(0, len(size), STEP_DOCS):
        z = min(len(size), a + STEP_DOCS)
        own = row[term[starts[a] : starts[z]]]
        of = np.repeat(np.arange(a, z), size[a:z])
        all_[of[own >= 0], own[own >= 0]] = True
    done, todo = [], [np.arange(len(size))]
    while todo:
        own = todo.pop()
        left = np.zeros(len(own), bool)
        if len(own) > 1 and len(own) > most // 4:
            has = all_[own]
            has = has[:, np.argsort(-has.sum(0), kind="stable")[:ORDER_TERMS]].astype(np.float32)
            has /= np.sqrt(np.maximum(has.sum(1), 1))[:, None]
            has -= has.mean(0)
            share, axes = np.linalg.eigh(has.T @ has)
            if len(share) and share[-1] > AXIS * share.sum():
                left = has @ axes[:, -1] < 0
        if not len(own) / 32 <= left.sum() <= len(own) * 31 / 32:
            if len(own) <= most and size[own].sum() <= most_terms or len(own) < 2:
                done.append(own)
                continue
            left = np.arange(len(own)) < len(own) // 2
            own = own[np.argsort(size[own], kind="stable")]
        todo += [own[left], own[~left]]
    return sorted(done, key=lambda own: -size[own].sum() / max(1, len(own)))


def top_k(
    docs: DataFrame, queries: DataFrame, text: str = "text", k: int = 10, k1: float = 1.2, b: float = 0.75, shard_docs: int = 16_000, block_queries: int = 100_000, group_docs: int = 1_000_000
) -> DataFrame:
    """``(query_id, doc_id, rank, score)``: the k best documents for each row of ``queries(query_id, text)``.

    BM25 over the distinct terms of the whole query text; terms are runs of ASCII
    letters and digits and non-ASCII signs, in lower case. Ties go by doc_id. A null
    or empty text finds nothing and is not found; so does a row without id. Rows that
    share a doc_id count as documents of their own, rows that share a query_id give
    one result each and are told apart by nothing.

    Document counts, document frequencies and the mean length are those of the whole
    table, so scores from different shards can be merged. Each group of about
    ``group_docs`` documents at most, but no fewer groups than tasks run at once, meets
    each block of about ``block_queries`` queries. A task streams the documents past the
    queries in shards of about ``shard_docs``, and gives k rows a query. Only terms that
    a query has are sent.
    """
    spark = docs.sparkSession
    total = docs.filter("doc_id IS NOT NULL").count()
    asked = written(vectors(queries.select(F.col("query_id").alias("doc_id"), text), text))
    marks = spark.sparkContext.broadcast(bit_table(asked.select("known"), lambda batch: _bucket(_all_known(batch)), MARKS))
    told = written(vectors(docs, text, marks))
    n_docs, words = told.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    n_asked = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(n_asked / block_queries))
    tasks = min(spark.sparkContext.defaultParallelism, math.ceil(4 * total / shard_docs))
    n_groups = max(1, math.ceil(total / group_docs), math.ceil(tasks / n_blocks))
    collection = (n_docs, words / max(1, n_docs), k1, b)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.to_pylist()
            term, at = np.unique(np.concatenate([unpacked(r, "known") for r in each]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([unpacked(r, "often") for r in each]), minlength=len(term))
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n.astype(np.int64))], ["term", "n"])

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                known = unpacked(r, "known")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(known), r["block"])), pa.array(known)], ["block", "term"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, term, df = (batch.column(c).to_numpy() for c in ("block", "term", "df"))
            for one in np.unique(block):
                columns = packed(known=term[block == one], often=df[block == one])
                yield pa.RecordBatch.from_arrays([pa.array([one]), *columns], ["block", *PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, at = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["cell"] != at:
                    if cell:
                        yield pa.RecordBatch.from_arrays(cell.best(), ["query_id", "doc_id", "score"])
                    cell, at = Cell(k, shard_docs, *collection), row["cell"]
                cell.add(row["kind"], row)
        if cell:
            yield pa.RecordBatch.from_arrays(cell.best(), ["query_id", "doc_id", "score"])
        pa.default_memory_pool().release_unused()

    def each(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # Rows of stored tables are dealt in turn.
    turn = F.monotonically_increasing_id()
    in_blocks = asked.withColumn("block", F.pmod(turn, F.lit(n_blocks)))
    df = told.select("known", "often").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))
    terms_of = in_blocks.select("block", "known").mapInArrow(vocabulary, "block long, term long").distinct()
    stats = terms_of.join(df, "term").select("block", "term", "df").mapInArrow(together, f"block long, {CHUNK}")
    in_groups = told.withColumn("group", F.pmod(turn, F.lit(n_groups))).withColumn("block", each(n_blocks))
    rows = [stats.withColumn("group", each(n_groups)), in_blocks.withColumn("group", each(n_groups)), in_groups]
    cell = (F.col("block") * n_groups + F.col("group")).cast("int").alias("cell")
    rows = [x.select(cell, F.lit(kind).alias("kind"), *PACKED) for kind, x in zip((FREQUENCIES, QUERIES, DOCUMENTS), rows, strict=True)]
    rows = rows[0].union(rows[1]).union(rows[2]).repartitionById(n_blocks * n_groups, F.col("cell")).sortWithinPartitions("cell", "kind")
    best = rows.mapInArrow(run, "query_id long, doc_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "doc_id", "rank", "score")


def _all_known(batch: pa.RecordBatch) -> np.ndarray:
    return np.concatenate([unpacked(r, "known") for r in batch.to_pylist()])
