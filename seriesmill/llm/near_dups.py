"""Groups of near-duplicate documents by SuperMinHash, banding, verification and union-find."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import hashed_words, mixed, pieces, shingles, u64, written
from seriesmill.llm.components import components

_STEP = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Shingles are counted in so many buckets to put rare ones first.
RARITY_BUCKETS = 1 << 22
#: Elements that get a permutation of their own at once.
BLOCK = 120_000


def superminhash(values: np.ndarray, of: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures of ``m`` entries for ``n`` sets (``of`` ascending: the set of each element).

    Every element has a random permutation of the entries; in step j it offers entry
    ``p[j]`` a rank in ``[j, j + 1)``, and the smallest offer stays. The steps of all
    elements go in parallel; a set is done when every entry is taken, as later steps
    can only offer more. Permutations are shuffled step by step and only for sets that
    need a second one.
    """
    out = np.full(n * m, _NONE, np.uint64)
    rank, swap = _draw(values, 0, m)
    np.minimum.at(out, of * m + swap, rank)
    size = np.bincount(of, minlength=n)
    left = np.flatnonzero((size > 0) & (out.reshape(n, m) == _NONE).any(1))
    first = np.cumsum(size) - size
    at = 0
    while at < len(left):
        to = at + max(1, int(np.searchsorted(np.cumsum(size[left[at:]]), BLOCK, "right")))
        sets = left[at:to]
        at = to
        e = np.repeat(first[sets] - np.cumsum(size[sets]) + size[sets], size[sets]) + np.arange(size[sets].sum())
        v, o = values[e], of[e]
        perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(v), 1))
        rows = np.arange(len(v))
        s = swap[e]
        perm[:, 0], perm[rows, s] = s, 0
        perm[s == 0, 0] = 0
        for j in range(1, m):
            rank, s = _draw(v, j, m)
            slot = perm[rows, s].astype(np.int64)
            perm[rows, s] = perm[:, j]
            perm[:, j] = slot
            np.minimum.at(out, o * m + slot, rank)
            if j < 8 or j % 8 == 0:
                open_ = (out.reshape(n, m)[sets] == _NONE).any(1)
                if not open_.all():
                    sets = sets[open_]
                    stay = np.isin(o, sets)
                    v, o, perm = v[stay], o[stay], perm[stay]
                    rows = np.arange(len(v))
                    if not len(v):
                        break
    return out.reshape(n, m)


def _draw(values: np.ndarray, j: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank in step j (as an integer that grows with the step), and the place to swap with."""
    x = mixed(values + u64(int(_STEP) * (j + 1)))
    return (np.uint64(j) << np.uint64(48)) | (x >> np.uint64(16)), (j + (mixed(x + _STEP) % np.uint64(m - j)).astype(np.int64))


def described(docs: DataFrame, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, th, n, k1, k2, bands)``: set size, 128-bit hash of the set, band keys."""
    m = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                k = part.num_rows
                value, of = shingles(*hashed_words(part.column(text)), words, k)
                size = np.bincount(of, minlength=k)
                keys = []
                for salt in (1, 2):
                    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(value + u64(int(_STEP) * salt)))))
                    ends = np.cumsum(size)
                    keys.append(mixed(sums[ends] - sums[ends - size] + size.astype(np.uint64)).view(np.int64))
                signature = superminhash(value, of, k, m).reshape(k, bands, rows)
                band = np.tile(np.arange(bands, dtype=np.uint64) * _STEP, (k, 1))
                for r in range(rows):
                    band = mixed(band * np.uint64(3) + signature[:, :, r])
                band = band[size > 0].view(np.int64)
                cuts = np.concatenate(([0], np.cumsum(np.where(size > 0, bands, 0))))
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(band.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array(size), pa.array(keys[0]), pa.array(keys[1]), lists], ["doc_id", "th", "n", "k1", "k2", "bands"])

    rows_ = docs.select("doc_id", F.xxhash64(text).alias("th"), text)
    return rows_.mapInArrow(run, "doc_id long, th long, n long, k1 long, k2 long, bands array<long>")


def whole_sets(docs: DataFrame, wanted: DataFrame, text: str, words: int) -> DataFrame:
    """``(rep, th, s)``: the whole shingle sets of the documents in ``wanted(rep, th)``."""
    texts = docs.select(F.col("doc_id").alias("rep"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                value, of = shingles(*hashed_words(part.column("text")), words, part.num_rows)
                cuts = pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(cuts, pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("th"), lists], ["rep", "th", "s"])

    return texts.join(wanted, ["rep", "th"]).mapInArrow(run, "rep long, th long, s array<long>").dropDuplicates(["rep", "th"])


def confirmed(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """Edges for the ``pairs(a, ta, b, tb)`` whose whole sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("th").alias("ta"), F.col("s").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("th").alias("tb"), F.col("s").alias("y"))
    both = pairs.join(left, ["a", "ta"]).join(right, ["b", "tb"])
    same = F.size(F.array_intersect("x", "y"))
    good = same * least.denominator >= (F.size("x") + F.size("y") - same) * least.numerator
    return both.filter(good).select(F.col("a").alias("u"), F.col("b").alias("v"))


def prefix_pairs(rest: DataFrame, least: Fraction) -> DataFrame:
    """Candidates ``(a, ta, b, tb)`` between components of ``rest(rep, th, comp, s)``.

    Similar sets share a shingle within the first ``n - ceil(least * n) + 1`` of each,
    whatever order all have in common; rare shingles come first, so that a passage
    which many documents have gives no candidates. Place and bitmap bound the overlap
    from above. Nothing is lost here.
    """
    a, b = least.numerator, least.denominator
    names, bits = ["rep", "th", "comp"], [f"m{k}_" for k in range(16)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY_BUCKETS, np.int32)
        for batch in batches:
            np.add.at(total, batch.column("s").flatten().to_numpy() & (RARITY_BUCKETS - 1), 1)
        some = np.flatnonzero(total)
        for k in range(0, len(some), 100_000):
            at = some[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["b", "n"])

    counted = rest.select("s").mapInArrow(count, "b int, n int").groupBy("b").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n")).toArrow()
    rare = np.zeros(RARITY_BUCKETS, np.int32)
    rare[counted["b"].to_numpy()] = counted["n"].to_numpy()
    shared = rest.sparkSession.sparkContext.broadcast(rare)  # RARITY_BUCKETS numbers

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch.column("s").offsets.to_numpy()).astype(np.int64)
            value = batch.column("s").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), size)
            number = shared.value[value & (RARITY_BUCKETS - 1)]
            order = np.lexsort((value, number, row))
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            keep = (place < (size - (a * size + b - 1) // b + 1)[row]) & (number[order] > 1)
            # A bitmap of the whole set: two sets differ at least where their bitmaps do.
            bit = (mixed(value.view(np.uint64)) >> np.uint64(54)).astype(np.int64)
            maps = np.zeros((batch.num_rows, 16), np.uint64)
            np.bitwise_or.at(maps, (np.repeat(np.arange(batch.num_rows), size), bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
            row = row[keep]
            columns = [pa.array(value[order][keep]), *(batch.column(c).take(pa.array(row)) for c in names), pa.array(size[row]), pa.array(place[keep])]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(maps[row, k].view(np.int64)) for k in range(16)], ["s", *names, "n", "at"] + bits)

    posted = written(rest.mapInArrow(post, "s long, rep long, th long, comp long, n long, at long, " + ", ".join(f"{x} long" for x in bits)))
    several = posted.groupBy("s").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("s")
    posted = posted.join(several, "s")
    renamed = {"rep": "b", "th": "tb"} | {c: f"{c}2" for c in ["comp", "n", "at", *bits]}
    other = posted.withColumnsRenamed(renamed)
    need = f"(({a} * (n + n2) + {a + b - 1}) div {a + b})"
    differ = " + ".join(f"bit_count({x} ^ {x}2)" for x in bits)
    close = f"rep > b AND comp <> comp2 AND least(n - at, n2 - at2) >= {need} AND {differ} <= n + n2 - 2 * {need}"
    return posted.join(other, "s").filter(close).select(F.col("rep").alias("a"), F.col("th").alias("ta"), "b", "tb").distinct()


def _open(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with theirs."""
    own = shared.join(found, shared["rep"] == found["vertex"], "left").withColumn("comp", F.coalesce("component", "rep"))
    own = written(own.select("band", "key", "rep", "th", "n", "comp"))
    several = own.groupBy("band", "key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    return own.join(several.select("band", "key"), ["band", "key"])


def near_duplicates(docs: DataFrame, text: str = "text", words: int = 5, similarity: str = "0.8", bands: int = 32, rows: int = 5, centres: int = 4) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row: the smallest doc_id reachable over links.

    Two documents are linked if their sets of ``words``-word shingles have a Jaccard
    similarity of ``similarity`` or more (confirmed on the whole sets of 64-bit hashes).
    Documents without words have an empty set and no links. A link at the limit is
    missed by all bands with probability (1 - similarity ** rows) ** bands, 3e-6 by default.

    Equal sets are one vertex, so copies make no pairs. The members of a bucket of a
    band are compared with ``centres`` of them, chosen by a hash. Members of buckets
    that still hold several components are joined by prefix filter, between
    components only: that finds every link among them.
    """
    least = Fraction(similarity)
    told = written(described(docs, text, words, bands, rows))
    classes = told.filter("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2", "n").agg(F.min_by(F.struct("doc_id", "th", "bands"), F.struct("doc_id", "th")).alias("r"))
    classes = written(classes.select("k1", "k2", "n", F.col("r.doc_id").alias("rep"), "r.th", "r.bands"))
    members = classes.select("rep", "th", "n", F.posexplode("bands").alias("band", "key"))
    close = f"least(n, n2) * {least.denominator} >= greatest(n, n2) * {least.numerator}"
    several = members.groupBy("band", "key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    shared = written(members.join(several.select("band", "key"), ["band", "key"]))
    sets = written(whole_sets(docs, shared.select("rep", "th").distinct(), text, words))
    order = [F.min(F.struct(F.xxhash64("rep", F.lit(c)).alias("o"), "rep", "th", "n")) for c in range(centres)]
    centre = shared.groupBy("band", "key").agg(F.array(*order).alias("cs")).select("band", "key", F.explode("cs").alias("c"))
    centre = centre.select("band", "key", F.col("c.rep").alias("b"), F.col("c.th").alias("tb"), F.col("c.n").alias("n2"))
    star = shared.join(centre, ["band", "key"]).filter("rep <> b").filter(close)
    star = star.select(F.col("rep").alias("a"), F.col("th").alias("ta"), "b", "tb").distinct()
    edges = written(confirmed(star, sets, least))

    apart = _open(shared, components(edges)).select("rep", "th", "comp").distinct()
    rest = written(sets.join(apart, ["rep", "th"]).select("rep", "th", "comp", "s"))
    final = components(edges.union(confirmed(prefix_pairs(rest, least), sets, least)))

    named = classes.join(final, classes["rep"] == final["vertex"], "left").select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = told.select("doc_id", "k1", "k2", "n").join(named, ["k1", "k2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
