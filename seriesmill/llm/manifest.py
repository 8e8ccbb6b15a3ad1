"""Merkle manifest of a dataset: one tree for each source and one over the sources.

Trees have a fan-out of 16 and are cut into aligned blocks of a fixed height. A block is
one row: its digests stand in one binary value in van Emde Boas order, which splits a
block at half its height into a top part and the parts below it, and these again. Where
a node stands is arithmetic on its depth and index (``address``); construction and the
reading of siblings use nothing else. The roots of the blocks are the leaves of the next
round of blocks, until each tree is one block. Paths then go down the rounds again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import crc_bucket, numbered, written

FAN = 16
#: Fan-out steps in a block: at most 16 ** 3 leaves, 140 kB.
HEIGHT = 3
_DIGEST = 32


def nodes_in(levels: int) -> int:
    """Nodes of a complete subtree with so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` at ``depth`` below the root stand in a block of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below, width = levels - top, FAN ** (depth - top)
    return nodes_in(top) + index // width * nodes_in(below) + address(below, depth - top, index % width)


@cache
def layout(levels: int) -> list[list[int]]:
    """Addresses of all nodes of a block, by depth and index."""
    return [address(levels, d, np.arange(FAN**d)).tolist() for d in range(levels)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Block:
    """A subtree as a byte array in van Emde Boas order; nodes that are not there take no part."""

    def __init__(self, store: bytearray | bytes, n: int, steps: int):
        self.store, self.steps, self.at = store, steps, layout(steps + 1)
        #: Nodes at each depth.
        self.width = [n]
        for _ in range(steps):
            self.width.append(-(-self.width[-1] // FAN))
        self.width.reverse()

    @classmethod
    def build(cls, leaves: list[bytes], steps: int) -> Block:
        block = cls(bytearray(), len(leaves), steps)
        last = max(block.at[d][w - 1] for d, w in enumerate(block.width))
        block.store = bytearray((last + 1) * _DIGEST)
        for i, digest in enumerate(leaves):
            block._put(steps, i, digest)
        for depth in range(steps - 1, -1, -1):
            for i in range(block.width[depth]):
                block._put(depth, i, hashlib.sha256("".join(block.run(depth + 1, i)).encode()).digest())
        return block

    def _put(self, depth: int, index: int, digest: bytes) -> None:
        at = self.at[depth][index] * _DIGEST
        self.store[at : at + _DIGEST] = digest

    def get(self, depth: int, index: int) -> str:
        at = self.at[depth][index] * _DIGEST
        return self.store[at : at + _DIGEST].hex()

    def run(self, depth: int, number: int) -> list[str]:
        """The digests of the nodes with one parent, which is ``number`` at the depth above."""
        return [self.get(depth, i) for i in range(number * FAN, min(self.width[depth], (number + 1) * FAN))]

    def paths(self, above: list[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
        """For each leaf: digests left and right of its path, from its own run to the end of ``above``."""
        ways = [above]
        for depth in range(1, self.steps + 1):
            down = []
            for number, way in enumerate(ways):
                run = self.run(depth, number)
                down += [[("".join(run[:k]), "".join(run[k + 1 :])), *way] for k in range(len(run))]
            ways = down
        yield from ways


def _steps(total: int) -> int:
    """Fan-out steps of a tree with so many leaves."""
    steps = 0
    while total > 1:
        total, steps = -(-total // FAN), steps + 1
    return steps


_BLOCK = "tree string, block long, whole boolean, total long, root string, n int, steps int, store binary, ids array<long>, forged binary"


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Nodes ``(tree, at, total, id, digest, forged)`` as blocks.

    ``whole``: the block is all of its tree. Only such a block may be lower than ``height``:
    in all others each node has a parent in the block, even a node without siblings.
    """
    size = FAN**height

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in ("id", "digest", "forged")}
        now = None

        def done() -> dict:
            tree, number, total = now
            whole = total <= size
            steps = _steps(total) if whole else height
            block = Block.build(held["digest"], steps)
            row = {
                "tree": tree, "block": number, "whole": whole, "total": total, "root": block.get(0, 0), "n": len(held["digest"]), "steps": steps,
                "store": bytes(block.store), "ids": held["id"], "forged": b"".join(x or bytes(_DIGEST) for x in held["forged"]),
            }
            for c in held:
                held[c] = []
            return row

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema)

        schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("whole", pa.bool_()), ("total", pa.int64()), ("root", pa.string()), ("n", pa.int32()), ("steps", pa.int32()), ("store", pa.binary()), ("ids", pa.list_(pa.int64())), ("forged", pa.binary())])
        rows = []
        for batch in batches:
            got = batch.to_pydict()
            for tree, at, total, i, digest, forged in zip(*(got[c] for c in ("tree", "at", "total", "id", "digest", "forged")), strict=True):
                key = (tree, at // size, total)
                if key != now:
                    if now is not None:
                        rows.append(done())
                    if len(rows) >= 64:
                        yield out(rows)
                        rows = []
                    now = key
                held["id"].append(i)
                held["digest"].append(digest)
                held["forged"].append(forged)
        if now is not None:
            yield out([*rows, done()])

    number = F.floor(F.col("at") / size).cast("long")
    dealt = nodes.withColumn("_block", number).repartition("tree", "_block").sortWithinPartitions("tree", "at")
    return dealt.select("tree", "at", "total", "id", "digest", "forged").mapInArrow(build, _BLOCK)


def _rounds(nodes: DataFrame, height: int) -> list[DataFrame]:
    """All rounds of blocks, lowest first, each a stored table."""
    rounds = []
    while True:
        blocks = written(_blocks(nodes, height))
        rounds.append(blocks)
        rest = blocks.where(~F.col("whole"))
        if rest.isEmpty():
            return rounds
        nodes = rest.select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("total") / FAN**height).cast("long").alias("total"), F.col("block").alias("id"),
            F.unhex("root").alias("digest"), F.lit(None).cast("binary").alias("forged"),
        )


_WAY = "path array<struct<left: string, right: string>>, subroot string, top string"
_PATH = f"tree string, block long, whole boolean, {_WAY}"
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _down(blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """``ways`` of the blocks of a round carried to their leaves, which are blocks of the round below."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                block = Block(row["store"], row["n"], row["steps"])
                above = [(p["left"], p["right"]) for p in row["path"]]
                paths = [[{"left": a, "right": b} for a, b in p] for p in block.paths(above)]
                n = len(paths)
                yield pa.RecordBatch.from_pydict(
                    {"tree": [row["tree"]] * n, "block": row["ids"], "whole": [False] * n, "path": paths, "subroot": [row["subroot"]] * n, "top": [row["top"]] * n},
                    _path_schema(),
                )

    joined = blocks.join(ways, ["tree", "block", "whole"])
    return joined.select("tree", "n", "steps", "store", "ids", "path", "subroot", "top").mapInArrow(carry, _PATH)


def _path_schema() -> pa.Schema:
    pair = pa.struct([("left", pa.string()), ("right", pa.string())])
    return pa.schema([("tree", pa.string()), ("block", pa.int64()), ("whole", pa.bool_()), ("path", pa.list_(pair)), ("subroot", pa.string()), ("top", pa.string())])


def _proofs(blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """The proof of each leaf of the lowest round, and the root that its digest, forged where one is given, folds to."""

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())]
        for batch in batches:
            for number in range(batch.num_rows):
                row = batch.slice(number, 1).to_pylist()[0]
                block = Block(row["store"], row["n"], row["steps"])
                out: dict[str, list] = {c: [] for c, _ in kinds}
                above = [(p["left"], p["right"]) for p in row["path"]]
                for k, path in enumerate(block.paths(above)):
                    forged = row["forged"][k * _DIGEST : (k + 1) * _DIGEST]
                    leaf = block.get(block.steps, k)
                    folded = forged.hex() if any(forged) else leaf
                    for left, right in path:
                        folded = sha(left + folded + right)
                    proof = sha("".join(left + right for left, right in path))
                    found = (row["ids"][k], leaf, row["subroot"], row["top"], proof, folded, folded == row["top"])
                    for (c, _), x in zip(kinds, found, strict=True):
                        out[c].append(x)
                yield pa.RecordBatch.from_pydict(out, pa.schema(kinds))

    joined = blocks.join(ways, ["tree", "block", "whole"])
    return joined.select("n", "steps", "store", "ids", "forged", "path", "subroot", "top").mapInArrow(prove, _PROOF)


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered(docs: DataFrame) -> Column:
    """The text of each fifth document (by crc32 of its doc_id) with A-Z in lower case, of the others as it is."""
    return F.when(crc_bucket("doc_id") == 0, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))


def manifest(docs: DataFrame, seen: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of each row of ``docs``.

    Digests are lowercase hex sha256; a leaf covers ``doc_id, source, lang, n_chars, text``.
    ``seen`` is the text that is found when a document is checked (default: the same
    text); ``folded_root`` is what it leads to with the siblings of the manifest.

    Null values count as a dash, differing from an empty text. Rows without doc_id come
    first in their source, those without source make the first tree. Rows that share a
    doc_id stand by their leaf digest; equal rows all stay. Other columns are ignored,
    an empty table has no rows. A text is hashed whole; a source may have any share of
    the rows, as leaves are numbered by sorted ranges and a block holds 16 ** ``height``.
    """
    base = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    forged = F.lit(None).cast("binary") if seen is None else F.when(~seen.eqNullSafe(F.col("text")), leaf_digest([*base[:4], seen]))
    # A key that is never null and sorts as the source does, null first.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    leaves = written(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("id"), leaf_digest(base).alias("digest"), forged.alias("forged")))
    rounds = _rounds(numbered(leaves, ["tree"], ["id", "digest"]), height)

    subroots = reduce(DataFrame.unionByName, [r.where("whole").select("tree", "root") for r in rounds])
    # The numbers of the sources among each other are the ids of the tree above them.
    sources = written(numbered(written(subroots.withColumn("all", F.lit(0))), ["all"], ["tree"]))
    above = _rounds(
        sources.select(F.lit("").alias("tree"), "at", "total", F.col("at").alias("id"), F.unhex("root").alias("digest"), F.lit(None).cast("binary").alias("forged")),
        height,
    )
    none = F.array().cast("array<struct<left: string, right: string>>")
    root = above[-1].where("whole")
    ways = root.select("tree", "block", "whole", none.alias("path"), F.lit("").alias("subroot"), F.col("root").alias("top"))
    for blocks in reversed(above):
        ways = _down(blocks, ways)
    # ``block`` is now the number of a source.
    tops = sources.withColumnRenamed("root", "_own").join(ways.select(F.col("block").alias("at"), "path", "top"), "at")
    tops = written(tops.select("tree", F.lit(0).cast("long").alias("block"), F.lit(True).alias("whole"), "path", F.col("_own").alias("subroot"), "top"))
    ways = tops
    for blocks in reversed(rounds[1:]):
        ways = written(_down(blocks, ways).unionByName(tops))
    return _proofs(rounds[0], ways)
