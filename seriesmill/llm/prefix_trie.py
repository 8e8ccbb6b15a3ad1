"""Trie of the turns of conversations, by burst tries.

A turn is known by an id, a digest of role and text. A conversation is one row with the
array of its turns; equal ones are merged first, so copies cost nothing further on. All
of them begin as one container of suffixes. A container that is too large is burst: the
turns that all its suffixes share become one head of the trie, a chain of nodes, and the
suffixes go on by their next turn id into smaller containers. What remains is sorted and
swept into nodes, a container at a time; heads add up what came out below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import written

#: Turns of a container that is swept as it is.
CONTAINER = 2048
#: Ids that travel as one row on their way to a digest.
_CHUNK = 4096
_TURN = "struct<turn: binary, words: long>"
_ROOT = b""
WORD = r"[^\x20\x09-\x0D]+"


def sequences(turns: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: the turns of each conversation as an array of id and number of words.

    In ascending order of ``turn``, null first, equal ones by id. A null role or text is
    empty. Rows without conv_id belong to no conversation and are left out. A conversation
    is one row: 16 bytes and a count for each turn.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    # 128 bits of the digest; the length keeps role and text apart.
    code = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text).cast("binary"), 256)), 1, 16)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"), code.alias("turn"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("a", "b", "turn", "words")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["turn"], t["words"])).alias("seq"))


def with_shared_heads(found: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of another: of c, the first h of c - c % ``every``.

    h is the crc32 of c in decimal modulo ``most``. Own turns follow after the first h; a
    conversation that is not there lends none.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    lent = found.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("seq", 1, most - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    none = F.array().cast(f"array<{_TURN}>")
    own = F.when(F.size("seq") > h, F.slice("seq", h + 1, F.greatest(F.size("seq"), F.lit(1)))).otherwise(none)
    joined = found.withColumn("_base", base).join(lent, "_base", "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), h), own).alias("seq"))


def _digests(members: DataFrame) -> DataFrame:
    """``(sid, ends_sha256)`` of the comma-joined ascending ids of each ``sid``.

    Ids are sorted by range and travel as packed runs. The digest is a chain, so one task
    reads the runs of a sid, in turn and without holding them.
    """
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {"sid": [], "first": [], "ids": []}
        now, ids = None, []

        def close() -> None:
            if ids:
                held["sid"].append(now)
                held["first"].append(ids[0])
                held["ids"].append(",".join(map(str, ids)))
                ids.clear()

        kinds = pa.schema([("sid", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
        for batch in batches:
            for sid, i in zip(batch.column("sid").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if sid != now or len(ids) >= _CHUNK:
                    close()
                    now = sid
                ids.append(i)
            yield pa.RecordBatch.from_pydict(held, kinds)
            held = {"sid": [], "first": [], "ids": []}
        close()
        yield pa.RecordBatch.from_pydict(held, kinds)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("sid", pa.binary()), ("ends_sha256", pa.string())])
        now, state = None, None
        for batch in batches:
            out: dict[str, list] = {"sid": [], "ends_sha256": []}
            for sid, ids in zip(batch.column("sid").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if sid != now:
                    if state:
                        out["sid"].append(now)
                        out["ends_sha256"].append(state.hexdigest())
                    now, state = sid, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_pydict(out, kinds)
        if state:
            yield pa.RecordBatch.from_pydict({"sid": [now], "ends_sha256": [state.hexdigest()]}, kinds)

    dealt = members.select("sid", "conv_id").repartitionByRange(tasks, "sid", "conv_id").sortWithinPartitions("sid", "conv_id")
    packed = dealt.mapInArrow(pack, "sid binary, first long, ids string")
    return packed.repartition("sid").sortWithinPartitions("sid", "first").select("sid", "ids").mapInArrow(digest, "sid binary, ends_sha256 string")


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, sid binary, container binary"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers, whose suffixes come one after another in ascending order.

    The topmost node of a container has no parent here; it names the container instead.
    """
    kinds = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), *[(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], ("sid", pa.binary()), ("container", pa.binary())]
    schema = pa.schema(kinds)
    nodes: list[list] = []  # least, depth, parent's place, convs, children, leaves, saved, sid
    words: list[int] = []
    now, skip, path, open_ = None, 0, [], []

    def close(depth: int) -> None:
        """Ends the open nodes below ``depth`` turns of the container and adds each to its parent."""
        while len(open_) > depth:
            k = open_.pop()
            node = nodes[k]
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * words[k]
            if open_:
                up = nodes[open_[-1]]
                up[0], up[3], up[4] = min(up[0], node[0]), up[3] + node[3], up[4] + 1
                up[5] += node[5]
                up[6] += node[6]

    def done() -> pa.RecordBatch:
        close(0)
        columns = list(zip(*nodes, strict=True))
        top = [p is None for p in columns[2]]
        columns[2] = [None if p is None else columns[0][p] for p in columns[2]]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip([*columns, [now if t else None for t in top]], kinds, strict=True)], schema=schema)
        nodes.clear()
        words.clear()
        return out

    for batch in batches:
        for r in range(batch.num_rows):
            head, skipped, sid, n, least = (batch.column(c)[r].as_py() for c in ("head", "skip", "sid", "n", "least"))
            seq = [(t["turn"], t["words"]) for t in batch.column("seq")[r].as_py()[skipped:]]
            if head != now:
                if nodes:
                    yield done()
                now, skip, path = head, skipped, []
            same = 0
            while same < min(len(seq), len(path)) and seq[same][0] == path[same][0]:
                same += 1
            close(same)
            for k in range(same, len(seq)):
                nodes.append([least, skip + k + 1, open_[-1] if open_ else None, 0, 0, 0, 0, None])
                words.append(seq[k][1])
                open_.append(len(nodes) - 1)
            # Suffixes of a container are not empty, and no two are the same.
            last = nodes[open_[-1]]
            last[0], last[3], last[7] = min(last[0], least), last[3] + n, sid
            path = seq
    if nodes:
        yield done()


def _burst(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Suffixes of containers that stay, all together, and the heads of those that were burst.

    ``rows``: ``(sid, seq, n, least)``, one for each different sequence. Heads are
    ``(unit, skip, chain, trail)``: the container, turns above it, the turns all of it share
    and the heads above. Suffixes that end with a head stay as rows without container.
    """
    spark = rows.sparkSession
    trail = F.array().cast("array<binary>")
    active = written(rows.select("*", F.lit(_ROOT).alias("head"), F.lit(0).alias("skip"), trail.alias("trail")))
    stay, heads = [], []
    while True:
        rest = F.expr("slice(seq, skip + 1, greatest(size(seq), 1))")
        # A turn costs itself, a suffix its row.
        weight = F.sum(F.size("seq") - F.col("skip") + 1)
        sizes = active.groupBy("head", "skip", "trail").agg(weight.alias("weight"), F.count(F.lit(1)).alias("rows"), F.min(rest).alias("lo"), F.max(rest).alias("hi"))
        # The first container is always burst: its head is the root of the trie.
        large = sizes.where((F.col("weight") > most) & (F.col("rows") > 1)) if heads else sizes
        short = F.least(F.size("lo"), F.size("hi"))
        differ = F.expr("if(least(size(lo), size(hi)) = 0, null, array_min(filter(sequence(0, least(size(lo), size(hi)) - 1), i -> lo[i].turn <> hi[i].turn)))")
        common = F.coalesce(differ, short).cast("int")
        found = written(large.select(F.col("head").alias("unit"), "skip", F.slice("lo", F.lit(1), common).alias("chain"), "trail"))
        heads.append(found)
        if found.isEmpty():
            stay.append(active)
            break
        split = active.join(found.select(F.col("unit").alias("head"), F.size("chain").alias("_more")), "head", "left")
        to = F.col("skip") + F.col("_more")
        code = F.substring(F.unhex(F.sha2(F.concat("head", F.expr("get(seq, skip + _more).turn")), 256)), 1, 16)
        moved = split.where(F.col("_more").isNotNull())
        stay.append(split.where(F.col("_more").isNull()).select(*active.columns))
        ended = moved.where(F.size("seq") == to).select(
            "sid", "seq", "n", "least", F.lit(None).cast("binary").alias("head"), to.alias("skip"), F.array_append("trail", F.col("head")).alias("trail")
        )
        stay.append(ended)
        below = moved.where(F.size("seq") > to).select("sid", "seq", "n", "least", code.alias("head"), to.alias("skip"), F.array_append("trail", F.col("head")).alias("trail"))
        active = written(below)
    return reduce(DataFrame.unionByName, stay), reduce(DataFrame.unionByName, heads)


def prefix_trie(found: DataFrame, most: int = CONTAINER) -> DataFrame:
    """Nodes of the trie of ``found(conv_id, seq)``, with one row for each conv_id (see ``sequences``).

    A node is a distinct sequence of first turns, from the root (no turns) on. It is known
    by ``conv_id``, its smallest member, and ``depth``. ``n_convs`` counts members,
    ``n_children`` the nodes one turn longer, ``n_leaves`` the childless nodes of its
    subtree, itself included; ``saved_tokens`` sums (n_convs - 1) times the words of the
    last turn over the subtree; ``ends_sha256`` covers the ids of members that end there.

    Without conversations there are no nodes, not even the root; a conversation without
    turns ends at the root. Equal conversations are one row with a count before anything
    is grouped by its beginnings, and a container has at most ``most`` turns or one row, so
    neither a frequent first turn nor copies meet in one task.
    """
    sid = F.substring(F.unhex(F.sha2(F.array_join(F.transform("seq", lambda t: F.hex(t["turn"])), "").cast("binary"), 256)), 1, 16)
    members = written(found.select("conv_id", "seq", sid.alias("sid")))
    rows = members.groupBy("sid").agg(F.first("seq").alias("seq"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    suffixes, heads = _burst(rows, most)
    suffixes, heads = written(suffixes), written(heads)

    inside = suffixes.where(F.col("head").isNotNull())
    swept = inside.select("head", "skip", "seq", "sid", "n", "least").repartition("head").sortWithinPartitions("head", "seq")
    nodes = written(swept.mapInArrow(_sweep, _NODE))

    # What each container, and each sequence that ends with a head, adds to the heads above.
    trails = inside.groupBy("head").agg(F.first("trail").alias("trail"))
    tops = nodes.where(F.col("container").isNotNull()).join(trails.withColumnRenamed("head", "container"), "container")
    parts = tops.select("trail", F.col("n_convs").alias("n"), F.col("conv_id").alias("least"), "n_leaves", "saved_tokens", F.lit(1).alias("child"), F.lit(None).cast("binary").alias("sid"))
    ended = suffixes.where(F.col("head").isNull())
    parts = parts.unionByName(ended.select("trail", "n", "least", F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"), F.lit(0).alias("child"), "sid"))
    each = parts.select("*", F.posexplode("trail").alias("_k", "unit")).withColumn("last", F.col("_k") == F.size("trail") - 1)
    sums = each.groupBy("unit").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.sum(F.when(F.col("last"), F.col("child")).otherwise(0)).alias("children"), F.max(F.when(F.col("last"), F.col("sid"))).alias("sid"),
    )
    units = written(heads.join(sums, "unit"))
    own = F.aggregate("chain", F.lit(0).cast("long"), lambda a, t: a + t["words"]) * (F.col("n") - 1)
    inner = units.select("trail", own.alias("own")).select("*", F.posexplode("trail").alias("_k", "unit"))
    inner = inner.groupBy("unit").agg(F.sum("own").alias("own"), F.sum((F.col("_k") == F.size("trail") - 1).cast("long")).alias("more"))
    above = units.select(F.col("unit").alias("_up"), F.col("least").alias("_parent"))
    full = units.join(inner, "unit", "left").withColumn("_up", F.try_element_at("trail", F.lit(-1))).join(above, "_up", "left")
    full = full.select(
        "unit", "skip", "chain", "n", "least", "sid", "_parent", F.size("chain").alias("size"),
        (F.col("saved") + F.coalesce("own", F.lit(0))).alias("saved"), (F.col("children") + F.coalesce("more", F.lit(0))).alias("children"), "leaves",
    )
    # A head gives a node for each turn of its chain; the first one also the root, place 0.
    place = F.explode(F.sequence(F.when(F.col("unit") == F.lit(_ROOT), 0).otherwise(1), F.col("size")))
    chain = full.withColumn("k", place)
    last = F.col("k") == F.col("size")
    below = F.expr("aggregate(slice(chain, greatest(k, 1), size(chain) + 1), 0L, (a, t) -> a + t.words)")
    head_nodes = chain.select(
        F.col("least").alias("conv_id"), (F.col("skip") + F.col("k")).cast("long").alias("depth"),
        F.when(F.col("k") > F.when(F.col("unit") == F.lit(_ROOT), 0).otherwise(1), F.col("least")).otherwise(F.col("_parent")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        # A head with nothing below is a leaf itself.
        F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"), (F.col("saved") + (F.col("n") - 1) * below).alias("saved_tokens"),
        F.when(last, F.col("sid")).alias("sid"),
    )
    parents = trails.select(F.col("head").alias("container"), F.try_element_at("trail", F.lit(-1)).alias("_up")).join(above, "_up").select("container", "_parent")
    top_nodes = nodes.join(parents, "container").withColumn("parent_conv_id", F.col("_parent"))
    # Only rows that have a key are joined by it: the others would meet in one task.
    every = nodes.where(F.col("container").isNull()).unionByName(top_nodes, allowMissingColumns=True)
    every = written(every.select(*head_nodes.columns).unionByName(head_nodes))
    out = every.drop("sid").columns
    ending = every.where(F.col("sid").isNotNull()).join(_digests(members), "sid")
    others = every.where(F.col("sid").isNull()).withColumn("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return ending.select(*out, "ends_sha256").unionByName(others.select(*out, "ends_sha256"))
