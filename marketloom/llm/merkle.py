"""Merkle manifests of datasets: leaf hashes per group, roots, and proofs by butterfly exchange."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm import words
from marketloom.session import materialise

_PLACE_BITS = (1 << 33) - 1  # of monotonically_increasing_id(), within a partition


def leaf_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 (hex) of the fields one after another: ``-`` if null, else UTF-8 byte count, ``:`` and the value."""
    text = [x.cast("string") for x in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in text]), 256)


def _hash(nodes: bytes) -> bytes:
    return sha256(nodes).hexdigest().encode()


def _ranked(rows: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in the order of ``by`` within ``g``, and ``n``, the rows of ``g``.

    A range partitioning puts all rows in order, so that a large group lies in
    many partitions; the ranks of a partition begin after those of the group's
    rows in the partitions before. Rows that agree in ``by`` are dealt by
    their place in the input. Runs jobs.
    """
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    order = ["g", *by, "tie"]
    placed = tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    placed = placed.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(_PLACE_BITS)})
    placed = materialise(placed, f"{label}-order")
    sizes = placed.groupBy("part", "g").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col("part").alias("p"), F.col("g").alias("h"), (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("base"), F.sum("size").over(Window.partitionBy("g")).alias("n")
    )
    joined = placed.join(bases, (F.col("part") == F.col("p")) & F.col("g").eqNullSafe(F.col("h")))
    return joined.withColumn("rank", F.col("base") + F.col("place")).drop("part", "place", "p", "h", "base")


def _levels(digests: list[bytes], n: int, fanout: int, levels: int) -> list[list[bytes]]:
    """Nodes of a block by level, its root last. A block that is the whole tree ends at its root; others have all levels."""
    nodes = [digests]
    for _ in range(levels):
        own = nodes[-1]
        if len(digests) == n and len(own) == 1:
            break
        nodes.append([_hash(b"".join(own[i : i + fanout])) for i in range(0, len(own), fanout)])
    return nodes


def _grouped(batches: Iterator[pa.RecordBatch], begins) -> Iterator[pa.Table]:
    """The rows from each row that ``begins`` marks to the next, in tables of their own."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cuts = np.flatnonzero(begins(batch)).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a in cuts[:1] or a and held:
                if held:
                    yield pa.Table.from_batches(held)
                held = []
            if a < b:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _block_roots(placed: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(g, block, blocks, digest): the roots of aligned blocks of ``fanout ** levels`` leaves."""
    width = fanout**levels
    kind = placed.schema["g"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _grouped(batches, lambda b: np.asarray(b.column("rank")) % width == 0):
            n = own.column("n")[0].as_py()
            root = _levels([x.encode() for x in own.column("leaf").to_pylist()], n, fanout, levels)[-1][0]
            yield pa.RecordBatch.from_arrays(
                [own.column("g").slice(0, 1).combine_chunks(), own.column("block").slice(0, 1).combine_chunks(), pa.array([-(-n // width)]), pa.array([root.decode()])],
                ["g", "block", "blocks", "digest"],
            )

    rows = placed.select("g", _block(width), "rank", "n", "leaf").repartition("g", "block").sortWithinPartitions("g", "block", "rank")
    return rows.mapInArrow(words.freed(run), f"g {kind}, block long, blocks long, digest string")


def _block(width: int) -> Column:
    return F.floor(F.col("rank") / width).cast("long").alias("block")


def _butterfly(roots: DataFrame, fanout: int, label: str) -> DataFrame:
    """(g, block, digest, path): the root of ``g`` in every block, and the block's proof up to it.

    In round r each block holds the root of its subtree of ``fanout ** r``
    blocks and sends it to one block of each sibling subtree, that of the same
    number within it; the last subtree may have fewer blocks, whose roots then
    go to several. Each block hashes what it heard, so all blocks of a subtree
    compute its parent, and each one's path grows by a level; no pass leads
    down. Runs a job for each round.
    """
    state = materialise(roots.withColumn("path", F.expr("cast(array() as array<struct<before:int,nodes:array<string>>>)")), f"{label}-blocks")
    most = state.agg(F.max("blocks")).first()[0] or 0
    width = 1
    while width < most:
        size = lambda u: F.least(F.lit(width), F.col("blocks") - u * width)  # noqa: B023, E731
        node = F.floor(F.col("block") / width).cast("long")
        nodes = F.ceil(F.col("blocks") / width).cast("long")
        state = state.withColumns({"node": node, "nodes": nodes}).withColumns(
            {"low": F.col("block") - F.col("node") * width, "step": size(F.col("node")), "lead": F.col("node") - F.col("node") % fanout}
        )
        siblings = F.filter(F.sequence("lead", F.least(F.col("lead") + fanout, "nodes") - 1), lambda u: u != F.col("node"))
        receivers = F.transform(
            siblings, lambda u: F.when(F.col("low") < size(u), F.sequence(u * width + F.col("low"), u * width + size(u) - 1, F.col("step"))).otherwise(F.expr("cast(array() as array<bigint>)"))
        )
        sent = state.select("g", F.explode(F.flatten(receivers)).alias("block"), "node", "digest")
        own = state.select("g", "block", "node", "digest", "blocks", "nodes", "path", F.col("node").alias("self"))
        heard = own.unionByName(sent, allowMissingColumns=True).groupBy("g", "block").agg(
            F.sort_array(F.collect_list(F.struct("node", "digest"))).alias("heard"),
            *[F.first(c, ignorenulls=True).alias(c) for c in ("blocks", "nodes", "path", "self")],
        )
        others = F.filter("heard", lambda x: x["node"] != F.col("self"))
        level = F.struct(
            F.size(F.filter("heard", lambda x: x["node"] < F.col("self"))).alias("before"), F.transform(others, lambda x: x["digest"]).alias("nodes")
        )
        joined = F.array_join(F.transform("heard", lambda x: x["digest"]), "")
        more = F.col("nodes") > 1  # else the block has the root of its group already
        state = heard.select(
            "g", "block", "blocks", F.when(more, F.sha2(joined, 256)).otherwise(F.col("heard")[0]["digest"]).alias("digest"), F.when(more, F.concat("path", F.array(level))).otherwise(F.col("path")).alias("path")
        )
        state = materialise(state, f"{label}-round")
        width *= fanout
    return state.select("g", "block", "digest", "path")


def _proved(placed: DataFrame, upper: DataFrame, fanout: int, levels: int, paths: bool) -> DataFrame:
    """A row of each leaf: (key, leaf, rank, subroot, root, proof, folded), and its path if asked for.

    ``upper`` has for every block the rest of the path above it; its row goes
    before the block's leaves.
    """
    width = fanout**levels
    kind = placed.schema["key"].dataType.simpleString()
    extra = ", path array<struct<before:int,nodes:array<string>>>" if paths else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _grouped(batches, lambda b: np.asarray(b.column("kind")) == 0):
            head = own.slice(0, 1).to_pylist()[0]
            above = [(x["before"] * 64, "".join(x["nodes"]).encode()) for x in head["path"]]
            top = b"".join(s for _, s in above)
            rows = own.slice(1)
            nodes = _levels([x.encode() for x in rows.column("leaf").to_pylist()], rows.column("n")[0].as_py(), fanout, levels)
            runs = [[b"".join(x[i : i + fanout]) for i in range(0, len(x), fanout)] for x in nodes[:-1]]
            proofs, folded, listed = [], [], []
            for i, now in enumerate(rows.column("presented").to_pylist()):
                proof, cur, j, path = sha256(), now.encode(), i, []
                for level in runs:
                    both, cut = level[j // fanout], j % fanout * 64
                    left, right = both[:cut], both[cut + 64 :]
                    proof.update(left + right)
                    cur = _hash(left + cur + right)
                    j //= fanout
                    if paths:
                        path.append((cut, left + right))
                proof.update(top)
                for cut, both in above:
                    cur = _hash(both[:cut] + cur + both[cut:])
                proofs.append(proof.hexdigest())
                folded.append(cur.decode())
                if paths:
                    listed.append([{"before": c // 64, "nodes": [s[k : k + 64].decode() for k in range(0, len(s), 64)]} for c, s in path + above])
            columns = [
                rows.column("key").combine_chunks(), rows.column("leaf").combine_chunks(), rows.column("rank").combine_chunks(),
                pa.array([head["subroot"]] * len(rows), pa.string()), pa.array([head["root"]] * len(rows), pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
            ]
            if paths:
                columns.append(pa.array(listed, pa.list_(pa.struct([("before", pa.int32()), ("nodes", pa.list_(pa.string()))]))))
            yield pa.RecordBatch.from_arrays(columns, ["key", "leaf", "rank", "subroot", "root", "proof", "folded", *["path"] * paths])

    leaves = placed.select("g", _block(width), F.lit(1).alias("kind"), "rank", "n", "key", "leaf", "presented")
    heads = upper.select("g", "block", F.lit(0).alias("kind"), "subroot", "root", "path")
    both = leaves.unionByName(heads, allowMissingColumns=True).repartition("g", "block").sortWithinPartitions("g", "block", "kind", "rank")
    return both.mapInArrow(words.freed(run), f"key {kind}, leaf string, rank long, subroot string, root string, proof string, folded string{extra}")


def manifest(
    df: DataFrame,
    fields: Sequence[str],
    key: str = "doc_id",
    group: str = "source",
    presented: Column | None = None,
    fanout: int = 16,
    levels: int = 3,
    paths: bool = False,
) -> DataFrame:
    """(key, leaf, rank, subroot, root, proof_sha256, folded_root, verified) of every row.

    A row's leaf is the ``leaf_hash`` of ``fields``. Per value of ``group``
    the leaves ascend by ``key`` (null first), then leaf; every ``fanout``
    consecutive nodes become the hash of their concatenation until one
    remains, the subroot; a lone leaf is one itself. The subroots, by group
    (null first, then bytewise for strings), likewise give the root.
    ``proof_sha256`` is the hash of all siblings on the way, level by level
    and left to right; ``paths`` adds them as ``path``, per level the number
    of siblings ``before`` the node and all of them as ``nodes`` (see
    ``fold``). ``folded_root`` is computed from the row's ``presented`` hash
    (default: its leaf) and the path; ``verified`` tells whether it is the
    root. Repeated rows are leaves of their own; an empty table has no rows.
    Columns but ``fields``, ``key`` and ``group`` are not read, whatever
    their names. A task holds a block of ``fanout ** levels`` leaves. Leaves,
    their order and the blocks' state after each round are written to the
    shared folder; runs jobs, one for each level above the blocks.
    """
    leaf = leaf_hash([F.col(c) for c in fields])
    leaves = df.select(F.col(group).alias("g"), F.col(key).alias("key"), leaf.alias("leaf"), (leaf if presented is None else presented).alias("presented"))
    placed = _ranked(materialise(leaves, "merkle-leaves"), ["key", "leaf"], "merkle")
    blocks = _butterfly(_block_roots(placed, fanout, levels), fanout, "merkle")
    # The subroots are the leaves of one more tree, of a single group.
    tops = blocks.filter("block = 0").select(F.lit(0).alias("g"), F.col("g").alias("key"), F.col("digest").alias("leaf"), F.col("digest").alias("presented"))
    tops = _ranked(tops, ["key", "leaf"], "merkle-top")
    above = _butterfly(_block_roots(tops, fanout, levels), fanout, "merkle-top")
    above = above.select("g", "block", F.col("digest").alias("subroot"), F.col("digest").alias("root"), "path")
    per_group = _proved(tops, above, fanout, levels, paths=True).select(F.col("key").alias("h"), "root", F.col("path").alias("rest"))
    per_group = materialise(per_group, "merkle-roots")
    upper = blocks.join(per_group, F.col("g").eqNullSafe(F.col("h"))).select("g", "block", F.col("digest").alias("subroot"), "root", F.concat("path", "rest").alias("path"))
    out = _proved(placed, upper, fanout, levels, paths)
    out = out.withColumn("verified", F.col("folded") == F.col("root"))
    return out.withColumnsRenamed({"proof": "proof_sha256", "folded": "folded_root"}).withColumnRenamed("key", key)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf hash and its ``path`` lead to."""
    part = lambda s, a, n: F.array_join(F.slice(s["nodes"], a, n), "")
    return F.aggregate(path, leaf, lambda x, s: F.sha2(F.concat(part(s, 1, s["before"]), x, part(s, s["before"] + 1, F.size(s["nodes"]))), 256))
