"""Merkle manifest against a plain recomputation, and odd rows."""

import hashlib
import zlib

import numpy as np
import pytest

from seriesmill.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, at int, tree string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return sha("".join(map(field, (r[0], r[3], r[2], r[4], text))))


def lower(s):
    return s.translate({k: k + 32 for k in range(65, 91)}) if s is not None else None


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, k):
    out = []
    for nodes in levels[:-1]:
        base = k // 16 * 16
        out.append(("".join(nodes[base:k]), "".join(nodes[k + 1 : base + 16])))
        k //= 16
    return out


def by_force(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[s] = levels_of([leaf_of(r, r[1]) for r in sources[s]])
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for number, s in enumerate(names):
        for k, r in enumerate(sources[s]):
            path = path_of(trees[s], k) + path_of(top, number)
            forged = zlib.crc32(str(r[0]).encode()) % 5 == 0 if r[0] is not None else False
            folded = leaf_of(r, lower(r[1]) if forged else r[1])
            for a, b in path:
                folded = sha(a + folded + b)
            proof = sha("".join(a + b for a, b in path))
            out.append((r[0], leaf_of(r, r[1]), trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(rng, n, sources):
    texts = ["Some Text", "lower", "", None, "ÀÉ Ü x", "A" * 5000]
    ids = rng.permutation(10 * n)[:n] - n
    return [
        (int(ids[k]), texts[rng.integers(6)], [None, "en", ""][rng.integers(3)], sources[int(rng.integers(len(sources)))], [None, 7][rng.integers(2)], "x", "y", 1, "z")
        for k in range(n)
    ]


@pytest.mark.parametrize("height", [1, 2])
def test_manifest_by_force(spark, height):
    """Low blocks, so that trees need several rounds of them."""
    rng = np.random.default_rng(height)
    rows = rows_of(rng, 700, ["hot"] * 30 + [None, "", "é", "=", "-", "z", "lone"])
    rows += rows[:5] + [(None, "Null Id", None, "hot", 3, "", "", 0, ""), (None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, manifest.manifest(docs, manifest.tampered(docs), height).collect()), key=repr)
    assert got == by_force(rows)


def test_many_sources_and_whole_blocks(spark):
    rng = np.random.default_rng(5)
    rows = rows_of(rng, 600, [f"s{k}" for k in range(300)])
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, manifest.manifest(docs, manifest.tampered(docs)).collect()), key=repr)
    assert got == by_force(rows)
    whole = manifest.manifest(docs)
    assert whole.where("not verified").count() == 0 and whole.count() == 600


def test_empty_table_and_one_row(spark):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(4, "Only", "en", "s", 4, "", "", 0, "")]
    r = manifest.manifest(spark.createDataFrame(rows, SCHEMA)).first()
    assert r.leaf == r.subroot == r.root == leaf_of(rows[0], "Only") and r.proof_sha256 == sha("")


def test_addresses_fill_a_block_and_keep_parts_together():
    for levels in (1, 2, 3, 4):
        all_of = sorted(a for row in manifest.layout(levels) for a in row)
        assert all_of == list(range(manifest.nodes_in(levels)))
    # Half of four levels: the 17 nodes of the top, then each lower part of 17 in one piece.
    rows = manifest.layout(4)
    assert sorted(rows[0] + rows[1]) == list(range(17))
    for k in range(256):
        part = sorted([rows[2][k], *rows[3][16 * k : 16 * k + 16]])
        assert part == list(range(17 + 17 * k, 34 + 17 * k))
