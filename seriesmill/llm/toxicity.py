"""Toxicity scores from a classifier that must not react to swapped identity terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import WORD_BREAK, flat, labelled_sample, lowered, pieces, prefix_sums, span_hashes, word_spans

# Words for groups of people that may be swapped for each other, by language; the first are neutral.
IDENTITY_TERMS = (
    "people", "persons", "women", "men", "girls", "boys", "gays", "lesbians", "straights", "christians", "muslims", "jews", "hindus",
    "buddhists", "atheists", "blacks", "whites", "asians", "africans", "americans", "europeans", "mexicans", "immigrants", "refugees",
    "foreigners", "blind", "deaf", "disabled", "old", "young", "woman", "man", "gay", "lesbian", "straight", "transgender", "christian",
    "muslim", "jewish", "hindu", "buddhist", "black", "white", "asian", "african", "american", "european", "mexican",
)
OTHER_TERMS = (
    ("gens", "femmes", "hommes", "filles", "garçons", "homosexuels", "chrétiens", "musulmans", "juifs", "athées", "noirs", "blancs", "asiatiques", "africains", "américains", "européens", "immigrés", "réfugiés", "étrangers", "aveugles", "sourds", "handicapés", "vieux", "jeunes"),
    ("leute", "frauen", "männer", "mädchen", "jungen", "homosexuelle", "christen", "muslime", "juden", "atheisten", "schwarze", "weiße", "asiaten", "afrikaner", "amerikaner", "europäer", "einwanderer", "flüchtlinge", "ausländer", "blinde", "gehörlose", "behinderte", "alte", "junge"),
    ("gente", "mujeres", "hombres", "niñas", "niños", "homosexuales", "cristianos", "musulmanes", "judíos", "ateos", "negros", "blancos", "asiáticos", "africanos", "americanos", "europeos", "inmigrantes", "refugiados", "extranjeros", "ciegos", "sordos", "discapacitados", "viejos", "jóvenes"),
)
GROUPS = (IDENTITY_TERMS, *OTHER_TERMS)
_ALL_TERMS = [t for g in GROUPS for t in g]
_GROUP = {t: (k, i) for k, g in reversed(list(enumerate(GROUPS))) for i, t in enumerate(g)}
_TERM = re.compile(r"\b(" + "|".join(sorted(_GROUP, key=len, reverse=True)) + r")\b")
#: Bytes of the word itself, then of its beginnings.
PREFIXES = (0, 3, 4, 5, 6, 7)


def _hashes(texts: pa.Array, keep) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of the features: distinct words and word beginnings that ``keep`` lets pass."""
    data, starts = flat(texts)
    begin, end, owner = word_spans(data, starts, WORD_BREAK)
    sums = prefix_sums(data)
    values, owners = [], []
    for k in PREFIXES:
        stop = end if k == 0 else begin + k
        use = np.arange(len(begin)) if k == 0 else np.flatnonzero(end - begin > k)
        value = span_hashes(sums, begin[use], stop[use]) ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        passed = keep(value)
        values.append(value[passed])
        owners.append(owner[use][passed])
    value, of = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], of[new]


def all_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return _hashes(texts, lambda value: slice(None))


class Chosen:
    """Looks the chosen features up in texts."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def keep(self, value: np.ndarray) -> np.ndarray:
        some = np.flatnonzero(self.filter[(value & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, value[some]), max(0, len(self.hashes) - 1))
        return some[self.hashes[at] == value[some]] if len(self.hashes) else some[:0]

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Column and text index of the chosen features that each text has."""
        value, of = _hashes(texts, self.keep)
        return np.searchsorted(self.hashes, value), of


def swapped(texts: pa.Array, times: int) -> tuple[list[str], list[int]]:
    """Counterfactuals of the texts that name a group: every term becomes another one of its language."""
    out, of = [], []
    for i, t in enumerate(texts.to_pylist()):
        if _TERM.search(t):
            for k in range(times):

                def other(m: re.Match, k: int = k) -> str:
                    group, at = _GROUP[m[0]]
                    return GROUPS[group][(at + 7 * k) % len(GROUPS[group]) if k else 0]

                out.append(_TERM.sub(other, t))
                of.append(i)
    return out, of


def named(texts: pa.Array, times: int) -> list[list[tuple[str, str]]]:
    """For each text that names no group, pairs of terms of one language: a sentence of it that
    names the one is the counterfactual of the same sentence with the other."""
    out = []
    for t in texts.to_pylist():
        pairs = []
        if t.strip() and not _TERM.search(t):
            seed = zlib.crc32(t.encode())
            for k in range(times):
                group = GROUPS[(seed + k) % len(GROUPS)]
                at = (seed >> 8) + 5 * k
                pairs.append((group[at % len(group)], group[(at + 1 + (seed >> 16) % (len(group) - 1)) % len(group)]))
        out.append(pairs)
    return out


class Changes:
    """Sparse rows of -1 and 1: the features a counterfactual loses and gains."""

    def __init__(self, rows: list[list[int]], width: int):
        """A feature gained is its number plus one, one lost the negative of that."""
        rows = [r for r in rows if r]
        size = [len(r) for r in rows]
        code = np.array([c for r in rows for c in r], np.int64)
        self.n, self.width = len(rows), width
        self.row, self.column, self.sign = np.repeat(np.arange(len(rows)), size), np.abs(code) - 1, np.sign(code).astype(float)

    def scaled(self, by: np.ndarray) -> Changes:
        out = Changes([], self.width)
        out.n, out.row, out.column, out.sign = self.n, self.row, self.column, self.sign * by[self.column]
        return out

    def pull(self, w: np.ndarray) -> np.ndarray:
        """Gradient of half the mean square of the score changes."""
        change = np.bincount(self.row, self.sign * w[self.column], self.n)
        return (np.bincount(self.column, self.sign * change[self.row], self.width) / max(1, self.n)).astype(np.float32)


@dataclass(frozen=True)
class ToxicityModel:
    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    #: Score changes the fit was held to: swapped terms that change a feature.
    penalised: int = 0

    def score(self, texts: pa.Array, chosen: Chosen) -> np.ndarray:
        column, of = chosen.find(lowered(texts))
        z = self.bias + np.bincount(of, weights=self.weights[column], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, delta: Changes, ridge: float = 1e-3, swap_penalty: float = 1.0, steps: int = 800, weight: float = 2.0) -> tuple[np.ndarray, float]:
    """Logistic loss (label 1 counts ``weight`` times), plus a ridge, plus ``swap_penalty`` times the mean square of the score changes.

    Gradient steps with momentum from zero; the step width follows from the data.
    """
    n, m = x.shape
    each = np.where(y == 1, weight, 1.0)
    w, b = np.zeros(m, np.float32), 0.0
    v, c = w.copy(), b
    curve = np.ones(m, np.float32)
    for _ in range(12):  # largest curvature
        curve /= max(np.linalg.norm(curve), 1e-9)
        curve = x.T @ (x @ curve) * np.float32(weight / (4 * n)) + swap_penalty * delta.pull(curve)
    width = 1 / (1.2 * np.linalg.norm(curve) + ridge + weight / 4)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v + c, -30, 30)))
        off = ((p - y) * each).astype(np.float32)
        g = x.T @ off / n + ridge * v + swap_penalty * delta.pull(v)
        w2, b2 = v - width * g, c - width * float(off.mean())
        pull = k / (k + 3)
        v, c = w2 + pull * (w2 - w), b2 + pull * (b2 - b)
        w, b = w2, b2
    return w.astype(float), float(b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_rows: int = 12_000, most_features: int = 1_024, swaps: int = 3, swap_penalty: float = 1.0) -> ToxicityModel:
    """Learns from at most ``most_rows`` labelled documents outside the held-out fold.

    The features with the strongest association with the label are counted in tasks;
    the driver gets their hashes and which of them each sampled row has. Words for groups are
    features in any case. Each sampled text has ``swaps`` counterfactuals: its own terms are
    swapped for others, or, if it names no group, a sentence of it with one term added is set against
    the same with another. The driver gets the features that differ.

    Without rows of both labels nothing is learned: all texts have one score. A null text
    counts as empty. Of several labels of a doc_id the largest counts, and rows that share
    one are rows of their own.
    """
    sample = labelled_sample(labels, label, most_rows)
    chosen_docs = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most most_rows rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                value, of = all_features(lowered(part.column("text")))
                y = part.column(label).to_numpy(zero_copy_only=False) == 1
                distinct, back = np.unique(value, return_inverse=True)
                hit = np.bincount(back, weights=y[of], minlength=len(distinct)).astype(np.int64)
                both = np.bincount(back, minlength=len(distinct))
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(hit), pa.array(both - hit), pa.array(np.zeros(len(distinct), np.int64))], ["h", "hit", "miss", "rows"])
                yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([int(y.sum())]), pa.array([int((~y).sum())]), pa.array([1])], ["h", "hit", "miss", "rows"])

    counted = chosen_docs.mapInArrow(count, "h long, hit long, miss long, rows long").groupBy("rows", "h").agg(F.sum("hit").alias("hit"), F.sum("miss").alias("miss"))
    counted = counted.checkpoint()
    total = counted.filter("rows = 1").first()
    pos, neg = (total["hit"], total["miss"]) if total else (0, 0)
    if not pos or not neg:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -2.0 if neg or not pos else 2.0)

    p1, p0 = (F.col("hit") + 0.5) / (pos + 1.0), (F.col("miss") + 0.5) / (neg + 1.0)
    lift = (p1 + p0) * F.abs(F.log(p1 / p0))
    best = counted.filter("rows = 0 AND hit + miss >= 3").select("h", lift.alias("lift"), F.abs(F.log(p1 / p0)).alias("odds")).orderBy(F.desc("lift"), "h").limit(most_features).collect()
    hashes = np.array([r["h"] for r in best], np.int64).view(np.uint64)
    odds = np.array([r["odds"] for r in best], np.float32)
    # Features of the terms that are not chosen anyway, as telling as the median of those that are.
    terms = np.setdiff1d(all_features(pa.array(_ALL_TERMS, pa.large_string()))[0], hashes)
    hashes, odds = np.concatenate((hashes, terms)), np.concatenate((odds, np.full(len(terms), np.median(odds) if len(odds) else 1.0, np.float32)))
    order = np.argsort(hashes)
    hashes, odds = hashes[order], odds[order]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Chosen(hashes)

        def found(texts: pa.Array) -> list[set[int]]:
            column, of = chosen.find(texts)
            return [set(x.tolist()) for x in np.split(column, np.searchsorted(of, np.arange(1, len(texts))))] if len(texts) else []

        of_term = dict(zip(_ALL_TERMS, found(pa.array(_ALL_TERMS, pa.large_string())), strict=True))
        for batch in batches:
            for p in pieces(batch, "text"):
                texts = lowered(p.column("text"))
                own = found(texts)
                changes: list[list[list[int]]] = [[] for _ in own]

                def differ(i: int, was: set[int], now: set[int], changes=changes) -> None:
                    changes[i].append([c + 1 for c in sorted(now - was)] + [-c - 1 for c in sorted(was - now)])

                changed, source = swapped(texts, swaps)
                for i, now in zip(source, found(pa.array(changed, pa.large_string())), strict=True):
                    differ(i, own[i], now)
                for i, pairs in enumerate(named(texts, swaps)):
                    for a, b in pairs:
                        differ(i, of_term[a] - own[i], of_term[b] - own[i])
                yield pa.RecordBatch.from_arrays(
                    [p.column("doc_id"), p.column(label).cast(pa.int32()), pa.array([sorted(x) for x in own], pa.list_(pa.int32())), pa.array(changes, pa.list_(pa.list_(pa.int32())))],
                    ["doc_id", "y", "at", "changes"],
                )

    rows = chosen_docs.mapInArrow(mark, "doc_id long, y int, at array<int>, changes array<array<int>>").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["at"], r["changes"]))
    x = np.zeros((len(rows), len(hashes)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = 1
    delta = Changes([c for r in rows for c in r["changes"]], len(hashes))
    # Columns are scaled by their log odds: the ridge costs telling features less.
    x *= odds
    w, b = fit_logistic(x, np.array([r["y"] for r in rows], np.float32), delta.scaled(odds), swap_penalty=swap_penalty)
    return ToxicityModel(hashes, w * odds, b, delta.n)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; null counts as empty.

    A column of ``docs`` named ``out`` is replaced. Rows are independent: no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Chosen(model.hashes)
        for batch in batches:
            for part in pieces(batch, text):
                found = pa.array(model.score(part.column(text), chosen))
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + [found], [f.name for f in kept] + [out])

    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{out}` double"]))
