"""Quality scores: pairs against brute force, rows spread over tasks against rows in memory."""

import random
import zlib

import numpy as np
import pyarrow as pa

from seriesmill.llm import quality


def all_pairs(x, y, ridge=1e-3):
    """Weights from every pair of a good and a bad row, and the threshold."""
    scale = np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = np.clip((x - x.mean(0)) / scale, -8, 8)
    diff = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-diff @ w))
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, diff.T @ (p - 1) / len(diff) + ridge * w)
    ranked, k = np.sort(z @ w), int((y == 0).sum())
    return w, (ranked[k - 1] + ranked[k]) / 2


def test_every_pair_counts():
    """Over 60,000 pairs, of which none may be left out."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, quality.N_FEATURES))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=700) > 0.6).astype(int)
    model = quality.fit_pairs(x, y, 0.3)
    w, threshold = all_pairs(x, y)
    assert np.abs(model.weights - w).max() < 1e-3 and abs(model.threshold - threshold) < 1e-3


def test_every_labelled_row_counts(spark):
    """More rows than a sample of 20,000 would hold: the model is that of all of them, whatever the tasks."""
    rng = random.Random(3)
    words = "the or ing tion ar! en ou, st ly".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9))) + "!" * (3 * (rng.random() < 0.3 + 0.4 * (i % 3 == 0)))) for i in range(27_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id long, quality int")
    found = quality.fit(docs.repartition(7), labels)
    kept = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    assert len(kept) > 20_000
    want = quality.fit_pairs(quality.features(pa.array([t for _, t in kept])), np.array([int(i % 3 > 0) for i, _ in kept]), 0.3)
    for name in ("mean", "scale", "weights", "threshold", "spread"):
        assert np.allclose(getattr(found, name), getattr(want, name), atol=1e-6), name
