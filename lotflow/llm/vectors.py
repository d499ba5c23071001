"""Near-duplicate vectors by NN-descent.

Method: a neighbour graph starts from sorted random-hyperplane codes and is
refined by joining each vector's neighbours and reverse neighbours with each
other, keeping the nearest ones. Lists whose every entry is a link are saturated
and may lack others: these vectors are cut into cells around leaders, and cells
of different components that the triangle inequality allows a link are compared
in full. The components that result are compared within, in blocks of bounded
size, so links are counted in full. The share of all links that components hold
is audited by comparing a bounded number of vectors with all others; until the
audit is passed, the graph is refined again from further codes, and if it never
is, cells of all vectors are compared. Links are confirmed in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import map_arrow, partitions, releasing, table
from lotflow.llm.components import components
from lotflow.session import materialize

#: Neighbours kept per vector, codes sorted per start, places linked along each order.
NEIGHBOURS, CODES, REACH = 8, 8, 4
#: Audited vectors: the bound of what is compared with all others and kept on the driver.
AUDIT = 256
#: Vectors of a block; two blocks are compared by one task.
BLOCK = 512
#: Vectors of small components that share a group.
GROUP = 8 * BLOCK
#: Least cosine of a vector with the leader of its cell.
CELL = 0.95
EDGE = "u bigint, v bigint, s double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of unit length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``rep, copies, x``: one row per distinct usable vector, ``rep`` its smallest id. Others link with nothing.

    Usable: not null, not empty, of finite components that are not all 0.
    """
    usable = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("x", lambda e: e != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    return rows.where(F.col("x").isNotNull() & usable).groupBy("x").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))


def start_edges(nodes: DataFrame, turn: int) -> DataFrame:
    """Edges between vectors close in the order of a random-hyperplane code, for CODES codes; hyperplanes follow from ``turn``."""

    def code():
        planes: dict[int, np.ndarray] = {}

        def step(batch):
            lists = batch.column("x")
            sizes = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
            out = {"t": [], "code": [], "c": [], "x": []}
            for size in np.unique(sizes):
                if size not in planes:
                    planes[size] = np.random.Generator(np.random.PCG64([turn, int(size)])).standard_normal((int(size), 62 * CODES))
                pick = np.flatnonzero(sizes == size)
                rows = _matrix(lists.take(pa.array(pick)))
                bits = (rows @ planes[size] > 0).reshape(len(rows), CODES, 62)
                values = (bits @ (np.int64(1) << np.arange(61, -1, -1))).astype(np.int64)
                for t in range(CODES):
                    out["t"].append(np.full(len(rows), t * 100_003 + int(size)))
                    out["code"].append(values[:, t])
                    out["c"].append(batch.column("c").take(pa.array(pick)).to_numpy())
                    out["x"] += list(rows.astype(np.float32))
            for k in ("t", "code", "c"):
                out[k] = np.concatenate(out[k])
            return out

        return step

    def link():
        def step(batch):
            t, c = batch.column("t").to_numpy(), batch.column("c").to_numpy()
            out = {"u": [], "v": [], "s": []}
            for kind in np.unique(t):
                pick = np.flatnonzero(t == kind)
                x, own = _matrix(batch.column("x").take(pa.array(pick))), c[pick]
                for w in range(1, REACH + 1):
                    s = np.einsum("ij,ij->i", x[:-w], x[w:])
                    for a, b in ((own[:-w], own[w:]), (own[w:], own[:-w])):
                        for k, v in zip(out, (a, b, s)):
                            out[k].append(v)
            return {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}

        return step

    coded = map_arrow(nodes, "t int, code bigint, c bigint, x array<float>", code)
    spark = nodes.sparkSession
    ordered = coded.repartitionByRange(partitions(spark), "t", "code", "c").sortWithinPartitions("t", "code", "c")
    return map_arrow(ordered, EDGE, link)


def nearest(edges: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest distinct neighbours of every vector as a list; few edges per vector come in."""
    once = edges.where("u <> v").groupBy("u", "v").agg(F.max("s").alias("s"))
    lists = once.groupBy("u").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("s")).alias("d"), "v"))), 1, keep).alias("near"))
    return lists


def refine(graph: DataFrame, nodes: DataFrame, keep: int) -> DataFrame:
    """One round: the neighbours and up to ``keep`` reverse neighbours of each vector are joined with each other."""
    edges = graph.select("u", F.explode("near").alias("e")).select("u", "e.v", (-F.col("e.d")).alias("s"))
    worst = graph.select(F.col("u").alias("c"), (-F.element_at("near", -1)["d"]).alias("worst"), (F.size("near") >= keep).alias("full"))
    # Reverse neighbours are sampled by hash: their number is not bounded.
    reverse = edges.select(F.col("v").alias("w"), F.col("u").alias("m"), F.xxhash64("u", "v").alias("h"))
    reverse = _sampled(reverse, keep)
    around = edges.select(F.col("u").alias("w"), F.col("v").alias("m")).union(reverse).distinct()
    vectors = nodes.join(worst, "c", "left").select(F.col("c").alias("m"), F.col("x").cast("array<float>").alias("x"), F.when(F.col("full"), F.col("worst")).otherwise(-2.0).alias("least"))
    groups = around.join(vectors, "m").groupBy("w").agg(F.collect_list(F.struct("m", "least", "x")).alias("g"))

    def make():
        def step(batch):
            lists = batch.column("g")
            bounds = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
            flat = lists.flatten()
            m, least = flat.field("m").to_numpy(), flat.field("least").to_numpy()
            xs = flat.field("x")
            sizes = np.diff(np.frombuffer(xs.buffers()[1], np.int32)[xs.offset : xs.offset + len(xs) + 1])
            out = {"u": [], "v": [], "s": []}
            for size in np.unique(sizes):
                pick = np.flatnonzero(sizes == size)
                x = np.zeros((len(m), int(size)))
                x[pick] = _matrix(xs.take(pa.array(pick)))
                ok = sizes == size
                for a, b in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0]):
                    s = x[a:b] @ x[a:b].T
                    i, j = np.nonzero((s > least[a:b, None]) & ok[a:b, None] & ok[None, a:b])
                    apart = i != j
                    for k, v in zip(out, (m[a:b][i[apart]], m[a:b][j[apart]], s[i[apart], j[apart]])):
                        out[k].append(v)
            u, v, s = (np.concatenate(x) if x else np.zeros(0) for x in out.values())
            # Only a vector's nearest ones of this batch go on.
            order = np.lexsort((v, -s, u))
            u, v, s = u[order], v[order], s[order]
            again = np.r_[False, (u[1:] == u[:-1]) & (v[1:] == v[:-1])] if len(u) else np.zeros(0, bool)
            u, v, s = u[~again], v[~again], s[~again]
            begins = np.flatnonzero(np.r_[True, u[1:] != u[:-1]]) if len(u) else np.zeros(0, np.int64)
            rank = np.arange(len(u)) - np.repeat(begins, np.diff(np.r_[begins, len(u)]))
            return {"u": u[rank < keep].astype(np.int64), "v": v[rank < keep].astype(np.int64), "s": s[rank < keep]}

        return step

    return nearest(edges.union(map_arrow(groups.select("g"), EDGE, make)), keep)


def _sampled(reverse: DataFrame, keep: int) -> DataFrame:
    """Up to about ``keep`` entries per ``w``: the smallest hash in each of ``keep`` hash buckets."""
    spread = reverse.groupBy("w", F.pmod("h", F.lit(keep)).alias("b")).agg(F.min(F.struct("h", "m")).alias("x"))
    return spread.select("w", "x.m")


def audit(roots: DataFrame, nodes: DataFrame, cosine: float) -> float:
    """Share of the links of up to AUDIT vectors whose ends have one root, which are those that are counted."""
    sample = nodes.orderBy(F.xxhash64("c"), "c").limit(AUDIT).collect()
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r.x), []).append((r.c, np.array(r.x)))
    queries = {n: (np.array([r[0] for r in rows]), (lambda m: m / np.linalg.norm(m, axis=1)[:, None])(np.array([r[1] for r in rows]))) for n, rows in by_size.items()}

    def make():
        def step(batch):
            out = {"q": [], "c": []}
            c, lists = batch.column("c").to_numpy(), batch.column("x")
            sizes = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
            for n, (ids, m) in queries.items():
                pick = np.flatnonzero(sizes == n)
                if len(pick):
                    i, j = np.nonzero(m @ _matrix(lists.take(pa.array(pick))).T >= cosine)
                    out["q"].append(ids[i])
                    out["c"].append(c[pick][j])
            return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}

        return step

    hits = map_arrow(nodes.select("c", "x"), "q bigint, c bigint", make).where("q <> c")
    rooted = lambda k: roots.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}"))
    both = hits.join(rooted("c"), "c", "left").join(rooted("q"), "q", "left")
    wanted, got = both.agg(F.count("*"), F.sum((F.col("root_c") == F.col("root_q")).cast("int"))).first()
    return 1.0 if not wanted else (got or 0) / wanted


def cells(members: DataFrame) -> DataFrame:
    """``c, root, x, cell``: members of a component around a leader ``cell`` with which they have a cosine of CELL or more."""
    blocks = members.groupBy("root").count().select("root", F.ceil(F.col("count") / BLOCK).cast("int").alias("k"))
    cut = members.join(blocks, "root").withColumn("b", F.pmod(F.xxhash64("c"), F.col("k")).cast("int"))
    alone = F.xxhash64("root", "b")
    cut = cut.withColumn("g", F.when(F.col("k") > 1, alone).otherwise(F.pmod(alone, F.lit(-(-members.count() // GROUP) or 1))))

    def make(rows: pa.Table) -> pa.Table:
        c, lists = rows["c"].to_numpy(), rows["x"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        keys = np.stack([rows["root"].to_numpy(), rows["b"].to_numpy(), sizes], axis=1)
        order = np.lexsort((c, *keys.T))
        cuts = np.flatnonzero(np.r_[True, (keys[order][1:] != keys[order][:-1]).any(axis=1), True])
        leader = np.zeros(len(c), np.int64)
        for a, z in zip(cuts[:-1], cuts[1:]):
            own = order[a:z]
            x, left = _matrix(lists.take(pa.array(own))), np.arange(z - a)
            while len(left):
                near = x[left] @ x[left[0]] >= CELL
                near[0] = True
                leader[own[left[near]]] = c[own[left[0]]]
                left = left[~near]
        return pa.table({"c": rows["c"], "root": rows["root"], "x": rows["x"], "cell": leader})

    return cut.select("g", "c", "root", "x", "b").groupBy("g").applyInArrow(releasing(make), "c bigint, root bigint, x array<double>, cell bigint")


def cross_links(members: DataFrame, cosine: float) -> DataFrame:
    """``a, b``: a link of every two cells of ``members(c, root, x)`` that have one and different roots.

    Exact: only cells whose leaders are further apart than the angle of a link and
    twice that of a cell are passed over.
    """
    found = materialize(cells(members), "cells")
    leaders = found.where("c = cell").select("cell", "root", "x")
    k = max(1, -(-leaders.count() // BLOCK))
    wide = np.cos(min(np.pi, np.arccos(min(1.0, cosine)) + 2 * np.arccos(CELL))) - 1e-6
    block = F.pmod(F.xxhash64("cell"), F.lit(k)).cast("int")
    pairs = leaders.select("cell", "root", "x", block.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("o"))
    pairs = pairs.select("cell", "root", "x", "b", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"))

    def meet(rows: pa.Table) -> pa.Table:
        cell, root, b, lists = rows["cell"].to_numpy(), rows["root"].to_numpy(), rows["b"].to_numpy(), rows["x"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        inner, out = rows["i"][0].as_py() == rows["j"][0].as_py(), []
        for size in np.unique(sizes):
            pick = np.flatnonzero(sizes == size)
            x = _matrix(lists.take(pa.array(pick)))
            apart = root[pick][:, None] != root[pick]
            if not inner:
                apart &= b[pick][:, None] != b[pick]
            p, q = np.nonzero(np.triu((x @ x.T >= wide) & apart, 1))
            out.append((cell[pick][p], cell[pick][q]))
        return pa.table({k: np.concatenate([o[n] for o in out]) for n, k in enumerate(("p", "q"))})

    near = materialize(pairs.groupBy("i", "j").applyInArrow(releasing(meet), "p bigint, q bigint"), "near_cells")
    sides = near.select("p", "q", F.col("p").alias("cell")).union(near.select("p", "q", F.col("q").alias("cell")))
    both = sides.join(found.select("cell", "c", "x"), "cell")

    def best(rows: pa.Table) -> pa.Table:
        c, cell, lists = rows["c"].to_numpy(), rows["cell"].to_numpy(), rows["x"].combine_chunks()
        x, left = _matrix(lists), cell == rows["p"][0].as_py()
        s = x[left] @ x[~left].T
        i, j = np.unravel_index(s.argmax(), s.shape)
        hit = slice(0, int(s[i, j] >= cosine))
        return pa.table({"a": c[left][i : i + 1][hit], "b": c[~left][j : j + 1][hit]})

    return both.groupBy("p", "q").applyInArrow(releasing(best), "a bigint, b bigint")


def count_links(nodes: DataFrame, roots: DataFrame, cosine: float) -> DataFrame:
    """``c, n``: links of every vector that links connect with others, copies counted.

    The vectors of a component are cut into blocks of about BLOCK; every two of
    its blocks meet in one task, which returns one number per vector.
    """
    member = nodes.select("c", "copies", "x").join(roots.select(F.col("node").alias("c"), "root"), "c")
    blocks = member.groupBy("root").count().select("root", F.ceil(F.col("count") / BLOCK).cast("int").alias("k"))
    member = member.join(blocks, "root").withColumn("b", F.pmod(F.xxhash64("c"), F.col("k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o")
    pairs = member.select("root", "c", "copies", "x", "b", "k", other).select("root", "c", "copies", "x", "b", "k", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"))
    # Small components share groups, so that a call compares many at once.
    alone = F.xxhash64("root", "i", "j")
    count = -(-roots.count() // GROUP) or 1
    pairs = pairs.withColumn("g", F.when(F.col("k") > 1, alone).otherwise(F.pmod(alone, F.lit(count))))

    def make(rows: pa.Table) -> pa.Table:
        root, c, copies, b = (rows[k].to_numpy() for k in ("root", "c", "copies", "b"))
        i, j = rows["i"].to_numpy(), rows["j"].to_numpy()
        lists = rows["x"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        n = np.zeros(len(c), np.int64)
        order = np.lexsort((sizes, j, i, root))
        keys = np.stack([root, i, j, sizes], axis=1)[order]
        cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
        for a, z in zip(cuts[:-1], cuts[1:]):
            own = order[a:z]
            x = _matrix(lists.take(pa.array(own)))
            near = (x @ x.T >= cosine) & (c[own][:, None] != c[own][None, :])
            if i[own[0]] != j[own[0]]:
                near &= b[own][:, None] != b[own][None, :]
            n[own] = near @ copies[own]
        return pa.table({"c": c, "n": n})

    return pairs.groupBy("g").applyInArrow(releasing(make), "c bigint, n bigint").groupBy("c").agg(F.sum("n").alias("n"))


def connected(graph: DataFrame, nodes: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Links of the lists with those that saturated lists may lack, and the components they form."""
    # A margin for single precision; the links are confirmed in double precision.
    near = graph.select("u", F.explode("near").alias("e")).select("u", "e.v", (-F.col("e.d")).alias("s")).where(F.col("s") >= cosine - 1e-5)
    once = near.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    side = lambda k: nodes.select(F.col("c").alias(k), F.col("x").alias(f"x{k}"))
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda a, b: a * b), F.lit(0.0), lambda t, e: t + e)
    links = once.join(side("a"), "a").join(side("b"), "b").where(dot("xa", "xb") / F.sqrt(dot("xa", "xa") * dot("xb", "xb")) >= cosine)
    links = materialize(links.select("a", "b"), "links")
    roots = materialize(components(links), "roots")
    # A link that no list has is one of two saturated lists.
    full = graph.where((F.size("near") >= NEIGHBOURS) & (F.element_at("near", -1)["d"] <= 1e-5 - cosine)).select(F.col("u").alias("c"))
    full = materialize(full.join(roots.withColumnRenamed("node", "c"), "c"), "saturated")
    if full.select("root").distinct().limit(2).count() < 2:
        return links, roots
    links = materialize(links.union(cross_links(nodes.select("c", "x").join(full, "c"), cosine)), "links")
    return links, materialize(components(links), "roots")


def link_vectors(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = 0.97, rounds: int = 2, turns: int = 4) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row.

    Rows link whose vectors have a cosine of ``cosine`` or more; equal vectors are
    one node of the graph. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, nor do vectors of different lengths.
    Repeated ids each get a row and count as rows, and of different vectors of a
    group with its smallest id one is kept; rows with a null id keep it and take
    the smallest id of their group, if any. Other columns are left out. An
    empty table gives no rows. ``rounds`` of refinement follow each of at most
    ``turns`` starts; they end when the audited recall is reached. If none reaches
    it, the cells of all vectors are compared.
    """
    nodes = clean(vectors, id_col, vector_col)
    # Numbered as written, since different vectors may have one id; in an order that follows from the vectors.
    nodes = materialize(nodes.sortWithinPartitions("rep", F.xxhash64("x")).withColumn("c", F.monotonically_increasing_id()), "vectors")
    graph = None
    for turn in range(turns):
        started = start_edges(nodes.select("c", "x"), turn)
        if graph is not None:
            started = started.union(graph.select("u", F.explode("near").alias("e")).select("u", "e.v", -F.col("e.d")))
        graph = materialize(nearest(started, NEIGHBOURS), "graph")
        for _ in range(rounds):
            graph = materialize(refine(graph, nodes.select("c", "x"), NEIGHBOURS), "graph")
        links, roots = connected(graph, nodes, cosine)
        reached = audit(roots, nodes.select("c", "x"), cosine) >= recall
        if reached:
            break
    if not reached:
        every = nodes.join(roots.withColumnRenamed("node", "c"), "c", "left").select("c", F.coalesce("root", "c").alias("root"), "x")
        roots = materialize(components(links.union(cross_links(every, cosine))), "roots")
    counts = count_links(nodes, roots, cosine)

    named = nodes.select("c", "rep", "copies", F.xxhash64("x").alias("h")).join(roots.select(F.col("node").alias("c"), "root"), "c", "left").join(counts, "c", "left")
    least = named.where("root IS NOT NULL AND rep IS NOT NULL").groupBy("root").agg(F.min(F.struct("rep", "h")).alias("least"))
    links_of = (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    first = F.coalesce(F.col("least.h") == F.col("h"), F.lit(True)).alias("first")
    named = named.join(least, "root", "left").select("c", links_of, F.coalesce("least.rep", "rep").alias("component"), first)
    named = materialize(nodes.select("c", "x").join(named, "c").select("x", "n_links", "component", "first"), "named")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    out = rows.join(named, "x", "left")
    component = F.coalesce("component", "id")
    kept = F.coalesce((F.col("id") == component) & F.coalesce("first", F.lit(True)), F.lit(False)).alias("kept")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept)


def op6_embedding_links(spark, sf_dir: str) -> DataFrame:
    """Links of all embeddings of cosine 0.9 and more."""
    return link_vectors(table(spark, sf_dir, "embeddings"))
