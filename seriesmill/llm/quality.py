"""Quality scores learned from preference pairs (Bradley-Terry)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from seriesmill.llm.common import Scratch, crc_bucket, flat, labelled, pieces, prefix_sums, span_hashes, word_spans

#: Bytes whose share of a text is a feature of its own.
SIGNS = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
N_FEATURES = len(SIGNS) + 10


def _share_of_new(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each text over all its values; 1 if it has none."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    count = np.bincount(owner, minlength=n)
    return np.where(count > 0, np.bincount(o[new], minlength=n) / np.maximum(count, 1), 1.0)


def features(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each whole text: sign shares, case, word shape, repetition."""
    data, starts = flat(texts)
    n = len(texts)
    size = np.maximum(np.diff(starts), 1)
    of_byte = np.repeat(np.arange(n), np.diff(starts))
    counts = np.bincount(of_byte * 256 + data, minlength=n * 256).reshape(n, 256)
    share = counts / size[:, None]
    begin, end, owner = word_spans(data, starts)
    words = np.bincount(owner, minlength=n)
    some = np.maximum(words, 1)
    hashes = span_hashes(prefix_sums(data), begin, end)
    odd = np.zeros(256, bool)
    odd[SIGNS] = True
    odd[[33, 44, 46, 63]] = False
    tail = np.bincount(owner[odd[data[end - 1]]], minlength=n) / some
    triple = hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] if len(hashes) > 2 else hashes[:0]
    inside = owner[:-2] == owner[2:] if len(hashes) > 2 else np.zeros(0, bool)
    breaks = np.zeros(256, bool)
    breaks[10] = True
    a, b, line_of = word_spans(data, starts, breaks)
    upper = counts[:, 65:91].sum(1)
    letters = np.maximum(upper + counts[:, 97:123].sum(1), 1)
    columns = [
        np.log1p(100 * share[:, SIGNS]),
        np.column_stack(
            [
                upper / letters,
                counts[:, 48:58].sum(1) / size,
                counts[:, 128:].sum(1) / size,
                np.log1p(words) / 10,
                np.minimum(np.bincount(owner, weights=end - begin, minlength=n) / some, 40) / 10,
                tail,
                _share_of_new(hashes, owner, n),
                _share_of_new(triple[inside], owner[:-2][inside] if len(inside) else owner[:0], n),
                _share_of_new(span_hashes(prefix_sums(data), a, b), line_of, n),
                np.log1p(np.bincount(line_of, minlength=n) / some),
            ]
        ),
    ]
    return np.concatenate(columns, axis=1)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float
    at_threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``at_threshold`` at the quantile that parts the classes."""
        raw = (np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.threshold) / self.spread
        return 1 / (1 + np.exp(-np.clip(raw + math.log(self.at_threshold / (1 - self.at_threshold)), -30, 30)))


#: Adds up ``make(x, y)``, an array of ``size`` numbers, over all blocks of rows.
Total = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray], int], np.ndarray]
#: Places of the grid that scores are weighed on, for a difference of 1, and places of one cell of curvature.
PLACES, CELL = 32, 16


def _logistic(d: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(d, -500, 500)))


def _against(mass: np.ndarray, kernel: Callable[[np.ndarray], np.ndarray], step: float) -> np.ndarray:
    """For each place i the sum over all places j of ``mass[j] * kernel((j - i) * step)``."""
    n = len(mass)
    size = 1 << (3 * n).bit_length()
    k = kernel(np.arange(n - 1, -n, -1) * step)
    return np.fft.irfft(np.fft.rfft(mass, size) * np.fft.rfft(k, size), size)[n - 1 : 2 * n - 1]


def _ranked(total: Total, score: Callable[[np.ndarray], np.ndarray], ranks: list[int]) -> list[float]:
    """The scores at these places, from 0, of all rows in ascending order: 13 bits of them at a time."""
    top = np.uint64(1 << 63)

    def ordered(x: np.ndarray) -> np.ndarray:
        raw = (score(x) + 0.0).view(np.uint64)
        return np.where(raw & top, ~raw, raw | top)

    heads, places = [0] * len(ranks), list(ranks)
    for shift, bits in ((51, 13), (38, 13), (25, 13), (12, 13), (0, 12)):

        def counts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            value = ordered(x)
            digit = (value >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)
            above = value >> np.uint64(shift) >> np.uint64(bits)
            return np.concatenate([np.bincount(digit[above == np.uint64(h)], minlength=1 << bits) for h in heads])

        for k, found in enumerate(np.cumsum(total(counts, len(ranks) << bits).reshape(len(ranks), -1), axis=1)):
            digit = int(np.searchsorted(found, places[k], "right"))
            places[k] -= int(found[digit - 1]) if digit else 0
            heads[k] = heads[k] << bits | digit
    values = np.array(heads, np.uint64)
    return np.where(values & top, values ^ top, ~values).view(np.float64).tolist()


def learn(total: Total, at_threshold: float, ridge: float = 1e-3, rounds: int = 60) -> QualityModel:
    """Weights from all pairs of a good and a bad document by the logistic loss of their feature difference.

    The loss of a pair depends on the difference of two scores only. So the scores of each
    class are spread over a grid, every score over the two places next to it, the sums over
    all pairs are convolutions of the two, and each row gets its weight between two places
    (off by under 1.2e-5 of a pair). Newton steps follow; their curvature is summed by cells of scores,
    which changes the way to the minimum, not the minimum.

    The threshold is the quantile of all scores below which the share of bad
    documents lies. Without both classes every score is above the threshold.
    """
    width = N_FEATURES
    n, n_good, n_bad, *sums = total(lambda x, y: np.concatenate(([len(y), (y == 1).sum(), (y == 0).sum()], x.sum(0))), 3 + width)
    mean = np.array(sums) / max(n, 1)
    scale = np.sqrt(total(lambda x, y: ((x - mean) ** 2).sum(0), width) / n) if n else np.ones(width)
    scale = np.where(scale > 1e-9, scale, 1.0)
    if not n_good or not n_bad:
        return QualityModel(mean, scale, np.zeros(width), -1.0, 1.0, at_threshold)
    pairs = n_good * n_bad

    def scaled(x: np.ndarray) -> np.ndarray:
        return np.clip((x - mean) / scale, -8, 8)

    def spread(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Weight of both classes on the grid, their rows in each cell, and the place of score 0."""
        middle = CELL * (int(8 * np.abs(w).sum() * PLACES) // CELL + 1)
        size, cells = 2 * middle + 1, 2 * middle // CELL + 1

        def make(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            place = scaled(x) @ w * PLACES + middle
            low = np.clip(place.astype(np.int64), 0, size - 2)
            out = []
            for label in (1, 0):
                at, part = low[y == label], (place - low)[y == label]
                out += [np.bincount(at, 1 - part, size) + np.bincount(at + 1, part, size), np.bincount(at // CELL, minlength=cells)]
            return np.concatenate(out)

        good, in_good, bad, in_bad = np.split(total(make, 2 * (size + cells)), np.cumsum([size, cells, size]))
        return good, bad, in_good, in_bad, middle

    def loss(w: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
        return float(good @ _against(bad, lambda d: np.logaddexp(0, d), 1 / PLACES) / pairs + ridge * (w @ w) / 2)

    def steep(d: np.ndarray) -> np.ndarray:
        return _logistic(d) * _logistic(-d)

    w = np.zeros(width)
    here = spread(w)
    cost = loss(w, *here[:2])
    for _ in range(rounds):
        good, bad, in_good, in_bad, middle = here
        pull = _against(bad, _logistic, 1 / PLACES), _against(good, lambda d: _logistic(-d), 1 / PLACES)
        curves = _against(in_bad, steep, CELL / PLACES), _against(in_good, steep, CELL / PLACES)
        cells = len(in_good)

        def slopes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = scaled(x)
            place = z @ w * PLACES + middle
            cell = np.clip(place.astype(np.int64), 0, 2 * middle - 1) // CELL
            gradient, curve, out = np.zeros(width), np.zeros((width, width)), []
            for label, sign, force, bend in ((1, -1, pull[0], curves[0]), (0, 1, pull[1], curves[1])):
                of = y == label
                gradient += sign * np.interp(place[of], np.arange(len(force)), force) @ z[of]
                curve += (z[of] * bend[cell[of]][:, None]).T @ z[of]
                by = np.zeros((cells, width))
                np.add.at(by, cell[of], z[of])
                out.append(by.ravel())
            return np.concatenate([gradient, curve.ravel(), *out])

        told = total(slopes, width + width * width + 2 * cells * width)
        gradient, curve, of_good, of_bad = np.split(told, np.cumsum([width, width * width, cells * width]))
        of_good, of_bad = of_good.reshape(cells, width), of_bad.reshape(cells, width)
        between = of_good.T @ np.column_stack([_against(c, steep, CELL / PLACES) for c in of_bad.T])
        curve = (curve.reshape(width, width) - between - between.T) / pairs + ridge * np.eye(width)
        step = np.linalg.solve(curve, gradient / pairs + ridge * w)
        for _ in range(30):
            ahead = spread(w - step)
            then = loss(w - step, *ahead[:2])
            if then <= cost + 1e-6:  # the grid's own error
                break
            step /= 2
        w, here, cost = w - step, ahead, then
        if np.abs(step).max() < 1e-6:
            break

    def raw(x: np.ndarray) -> np.ndarray:
        return scaled(x) @ w

    below, above = _ranked(total, raw, [int(n_bad) - 1, int(n_bad)])
    of_good, of_bad = total(lambda x, y: np.array([raw(x)[y == 1].sum(), raw(x)[y == 0].sum()]), 2)
    apart = max((of_good / n_good - of_bad / n_bad) / 8, 1e-6)
    return QualityModel(mean, scale, w, float((below + above) / 2), float(apart), at_threshold)


def fit_pairs(x: np.ndarray, y: np.ndarray, at_threshold: float) -> QualityModel:
    """``learn`` from rows in memory."""
    return learn(lambda make, size: make(x, y).astype(np.float64) if len(y) else np.zeros(size), at_threshold)


def _with_features(docs: DataFrame, text: str, keep: dict[str, str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                x = features(part.column(text))
                rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [rows], [*keep, "x"])

    return docs.select(*keep, text).mapInArrow(run, ", ".join(f"{c} {t}" for c, t in keep.items()) + ", x array<double>")


def _total(rows: DataFrame, label: str) -> Total:
    """Sums over stored rows: a task adds up its batches and sends one packed array to the driver."""

    def total(make: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy().reshape(-1, N_FEATURES)
                    out += make(x, batch.column(label).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([zstandard.compress(out.tobytes(), 1)], pa.binary())], ["sums"])

        out = np.zeros(size)
        for row in rows.select("x", label).mapInArrow(run, "sums binary").collect():
            out += np.frombuffer(zstandard.decompress(row.sums))
        return out

    return total


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", at_threshold: float = 0.3) -> QualityModel:
    """Learns from every labelled document outside the held-out fold.

    Their features are stored once and read again for each round of ``learn``; only sums
    come to the driver.
    """
    scratch = Scratch(docs.sparkSession)
    told = _with_features(docs.filter(crc_bucket("doc_id") != 0), "text", {"doc_id": "long"})
    # The order of the rows, and so of the sums, is the same in every run.
    rows = scratch.written(told.join(labelled(labels, label), "doc_id").sortWithinPartitions("doc_id"))
    model = learn(_total(rows, label), at_threshold)
    scratch.drop()
    return model


def score(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; null counts as empty.

    A column of ``docs`` named ``out`` is replaced. Rows are independent: no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                found = pa.array(model.score(features(part.column(text))))
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + [found], [f.name for f in kept] + [out])

    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{out}` double"]))
