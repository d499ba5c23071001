"""Merkle manifest of a dataset, and proofs folded from retained SHA-256 states.

Method: rows are leaves; every eight consecutive nodes of a level become the hash
of their concatenation. A parent is hashed child by child, and the hash state
before each child's slot is copied and retained; to fold a replaced child, the
state of its slot resumes with the replacement and its right siblings only.

Trees are cut into blocks of four levels, 4,096 nodes, so a language of any size
is spread over tasks and a task holds one block. Blocks rise until one node is
left; paths (what stands left and right of a node on each level above it) then
descend block by block, and the last blocks hash proofs and fold their leaves.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import partitions, table
from lotflow.session import materialize

#: Children of a node, levels of a block, nodes at the foot of a block.
FAN, DEPTH = 8, 4
BLOCK = FAN**DEPTH
PATH = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def levels(count: int) -> int:
    """Levels above ``count`` nodes until one is left."""
    up = 0
    while count > 1:
        count, up = -(-count // FAN), up + 1
    return up


class Tree:
    """A block: its nodes by level, and the hash states before each of them in its parent."""

    def __init__(self, nodes: list[bytes], height: int):
        self.rows, self.kept = [nodes], []
        for _ in range(height):
            kept, parents, now = [], [], self.rows[-1]
            for a in range(0, len(now), FAN):
                state = hashlib.sha256()
                for child in now[a : a + FAN]:
                    kept.append(state.copy())
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.kept.append(kept)
            self.rows.append(parents)

    @property
    def top(self) -> bytes:
        return self.rows[-1][0]

    def path(self, i: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of node ``i`` in its run, and of its ancestors in theirs."""
        out = []
        for row in self.rows[:-1]:
            a = i - i % FAN
            out.append((b"".join(row[a:i]), b"".join(row[i + 1 : a + FAN])))
            i //= FAN
        return out

    def fold(self, i: int, node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
        """The top with node ``i`` replaced."""
        for kept, (_, right) in zip(self.kept, path):
            state = kept[i].copy()
            state.update(node + right)
            node, i = state.hexdigest().encode(), i // FAN
        return node


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, the place in its group by ``order``, and ``n``, the group's size.

    One range shuffle over group and order, so a group of any size is spread; equal
    rows are spread by a salt, and their places may be exchanged.
    """
    salt = F.xxhash64(F.monotonically_increasing_id())
    spread = rows.withColumn("_salt", salt).repartitionByRange(partitions(rows.sparkSession), group, *order, "_salt")
    spread = spread.sortWithinPartitions(group, *order, "_salt").drop("_salt")
    # Rows of a group are consecutive in a partition; their numbers are read back as written.
    placed = materialize(spread.withColumn("_at", F.monotonically_increasing_id()), name).withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # One row per group and partition.
    before = F.expr(f"sum(_rows) OVER (PARTITION BY {group} ORDER BY _part) - _rows")
    parts = parts.withColumns({"_before": before, "n": F.expr(f"sum(_rows) OVER (PARTITION BY {group})")})
    parts = materialize(parts.drop("_rows"), f"{name}-parts")
    idx = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(parts, [group, "_part"]).withColumn("idx", idx).drop("_at", "_part", "_first", "_before")


def rise(nodes: DataFrame) -> DataFrame:
    """``g, idx, n, node``: the tops of the blocks of ``nodes``, which are the nodes of a tree again."""

    def top(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        count, place = rows["n"][0].as_py(), rows["idx"][0].as_py() // BLOCK
        tree = Tree([x.encode() for x in rows["node"].to_pylist()], min(DEPTH, levels(count)))
        return pa.table({"g": rows["g"][:1], "idx": [place], "n": [-(-count // BLOCK)], "node": [tree.top.decode()]})

    blocks = nodes.select("g", "idx", "n", "node", F.expr(f"idx div {BLOCK}").alias("b"))
    return blocks.groupBy("g", "b").applyInArrow(top, "g string, idx bigint, n bigint, node string")


def descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``g, idx, node, path``: the path to the root of every node, from those of its block's top in ``above``."""

    def paths(rows: pa.Table, top: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        tree = Tree([x.encode() for x in rows["node"].to_pylist()], min(DEPTH, levels(rows["n"][0].as_py())))
        rest = top["path"][0].as_py()
        path = [[{"left": a.decode(), "right": z.decode()} for a, z in tree.path(i)] + rest for i in range(len(rows))]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({"g": rows["g"], "idx": rows["idx"], "node": rows["node"], "path": pa.array(path, kind)})

    blocks = nodes.select("g", "idx", "n", "node", F.expr(f"idx div {BLOCK}").alias("b"))
    tops = above.select("g", F.col("idx").alias("b"), "path")
    return blocks.groupBy("g", "b").cogroup(tops.groupBy("g", "b")).applyInArrow(paths, f"g string, idx bigint, node string, path {PATH}")


def _layers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The nodes of a forest and the tops of their blocks, up to one node per group."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(materialize(rise(out[-1]), name))
    return out


def field(column: Column) -> Column:
    """A field of a leaf: ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def manifest(docs: DataFrame, changed: Column, columns: dict[str, Column], id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    A leaf hashes the id, then ``columns``, in their order; rows for which
    ``changed`` holds are folded with a leaf that takes the columns' second forms,
    ``columns`` giving them under the names of the first. ``group_col`` parts the
    rows into subtrees, null being a group of its own, the first. Leaves ascend by
    id, nulls first; rows of one id by their leaf; equal rows are exchangeable and
    each is a leaf. A null ``changed`` is false. Columns that are not named are no
    part of a leaf. Repeated ids fold each with its own place. An empty table
    gives no rows and has no root.
    """
    first = [F.col(id_col), *[F.col(c) for c in columns]]
    second = [F.col(id_col), *columns.values()]
    whole = leaf(first)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("1"), F.col(group_col)), F.lit("0")).alias("g"),
        whole.alias("node"),
        F.when(changed, leaf(second)).otherwise(whole).alias("other"),
    )
    leaves = ranked(materialize(rows, "leaves"), "g", ["id", "node"], "ordered")
    leaves = materialize(leaves, "leaves")
    trees = _layers(leaves, "nodes")
    subroots = trees[-1].select(F.lit("").alias("all"), F.col("g").alias("lang"), "node")
    named = materialize(ranked(subroots, "all", ["lang"], "subroots").withColumnRenamed("all", "g"), "subroots")
    roots = _layers(named, "roots")

    # Down again: from the root to the subroots, from these to the blocks of leaves.
    path = roots[-1].select("g", "idx", F.array().cast(PATH).alias("path"))
    for layer in reversed(roots[:-1]):
        path = materialize(descend(layer, path), "paths")
    root = roots[-1].agg(F.max("node")).first()[0]
    tops = named.select("idx", F.col("lang").alias("g"), F.col("node").alias("subroot")).join(path.select("idx", "path"), "idx")
    tops = materialize(tops.drop("idx").withColumn("root", F.lit(root).cast("string")), "tops")
    path = tops.select("g", F.lit(0).cast("long").alias("idx"), "path")
    for layer in reversed(trees[1:]):
        path = materialize(descend(layer, path), "paths")

    def prove(rows: pa.Table, top: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        nodes, others = ([x.encode() for x in rows[k].to_pylist()] for k in ("node", "other"))
        tree = Tree(nodes, min(DEPTH, levels(rows["n"][0].as_py())))
        upper = [(e["left"].encode(), e["right"].encode()) for e in top["path"][0].as_py()]
        beyond = b"".join(a + z for a, z in upper)
        # The states before the slots of this block's ancestors, for all its leaves.
        kept = [(hashlib.sha256(a), z) for a, z in upper]
        proofs, folded = [], []
        for i, other in enumerate(others):
            path = tree.path(i)
            proofs.append(hashlib.sha256(b"".join(a + z for a, z in path) + beyond).hexdigest())
            node = tree.fold(i, other, path)
            for before, right in kept:
                state = before.copy()
                state.update(node + right)
                node = state.hexdigest().encode()
            folded.append(node.decode())
        return pa.table({"id": rows["id"], "g": rows["g"], "leaf": rows["node"], "proof_sha256": proofs, "folded_root": folded})

    blocks = leaves.select("id", "g", "idx", "n", "node", "other", F.expr(f"idx div {BLOCK}").alias("b"))
    above = path.select("g", F.col("idx").alias("b"), "path")
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    proofs = blocks.groupBy("g", "b").cogroup(above.groupBy("g", "b")).applyInArrow(prove, f"id {kind}, g string, leaf string, proof_sha256 string, folded_root string")
    out = proofs.join(tops.select("g", "subroot", "root"), "g")
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_manifest(spark, sf_dir: str) -> DataFrame:
    """Proofs of all documents; a third are folded with their text in small letters."""
    docs = table(spark, sf_dir, "documents")
    columns = {c: F.col(c) for c in ("source", "lang", "n_chars")} | {"text": F.translate("text", UPPER, LOWER)}
    return manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0, columns)
