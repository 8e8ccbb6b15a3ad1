"""Line dedup: bitmaps of all widths lose no pair and leave out long lines that differ."""

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
from tests.llm.test_corpus import lines_by_force

from seriesmill.llm import line_dedup


def near(rng, n):
    """Two lines of about n words with a similarity of 0.8 or a little less or more."""
    one = [f"w{rng.randrange(10**9)}" for _ in range(n)]
    changed = max(0, round(n / 9) + rng.choice((-1, 0, 1)))
    other = one[changed:] + [f"w{rng.randrange(10**9)}" for _ in range(changed)]
    extra = rng.choice((0, 0, n // 5))
    return " ".join(one), " ".join(one + ["x" + w for w in one[:extra]] if extra else other)


def test_bitmaps_of_all_widths(spark):
    rng = random.Random(5)
    sizes = [9, 40, *range(52, 80), *range(155, 160), *range(184, 240, 3), 500]
    pairs = [near(rng, n) for n in sizes for _ in range(3)]
    corpus = [(i, line) for i, line in enumerate(x for pair in pairs for x in pair)]
    want = lines_by_force(corpus)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    found = line_dedup.dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in found} == want
    assert 20 < sum(r.n_removed for r in found) < len(pairs)


def test_long_lines_that_differ_are_no_candidates():
    """A thousand and more pairs share a rare word; all 64 bits of a narrow bitmap would be set."""
    rng = random.Random(6)
    lines = [" ".join(["shared"] + [f"w{rng.randrange(10**9)}" for _ in range(200)]) for _ in range(60)]
    sets = line_dedup.Lines(pa.array(lines), np.arange(60))
    words = [x.view(np.int64) for x in line_dedup.bitmaps(sets)]
    columns = [np.zeros(60, np.int64), np.arange(60), np.zeros(60, np.int64), sets.size << 32, *words]
    entries = pa.RecordBatch.from_arrays([pa.array(c) for c in columns + [np.ones(60, bool)]], [*line_dedup.COLUMNS, "open"])
    found = line_dedup._candidates(64, Fraction("0.8"), True)(iter([entries]))
    assert sum(b.num_rows for b in found) < 10


def test_texts_without_entries(spark):
    """A piece of the input that has none follows one that has."""
    line = " ".join(f"w{k}" for k in range(40))
    texts = [line, line + " more", "x" * (line_dedup.PIECE + 1), "alone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert [r.n_removed for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 1, 0, 0]


def test_sets_of_marked_lines(spark):
    """They are those of the lines of the whole texts; lines that are not marked have none."""
    texts = ["a b\n\nB a c\n", None, "", "\n", "x y\n \nz", "last é É\tA"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    lines = line_dedup.Lines(pa.array(texts), np.arange(len(texts)))
    want = {(d, k): set(lines.token[f : f + n].view(np.int64).tolist()) for d, k, f, n in zip(lines.doc, lines.line, lines.first, lines.size, strict=True)}
    assert sorted(want) == [(0, 0), (0, 2), (4, 0), (4, 2), (5, 0)]
    every = spark.sparkContext.broadcast(np.full(line_dedup.MARKS >> 3, 255, np.uint8))
    found = line_dedup._sets(docs, every, line_dedup.WIDE).collect()
    assert {(r.doc, r.line): set(r.t) for r in found} == want
    assert all(r.n == len(r.t) and sum(bin(r[m] & (1 << 64) - 1).count("1") for m in line_dedup.WIDE) <= r.n for r in found)
    pairs = spark.createDataFrame([(4, 2, 0, 2)], "xd long, xl long, yd long, yl long")
    some = spark.sparkContext.broadcast(line_dedup._marks(pairs))
    assert sorted((r.doc, r.line) for r in line_dedup._sets(docs, some, []).collect()) == [(0, 2), (4, 2)]


def test_one_python_worker_a_task(spark):
    """Packing and unpacking of texts stand in different stages, also where the lines to drop are few."""
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
