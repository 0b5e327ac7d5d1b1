"""Embedding near-dedup over a robust-pruned flat graph that is built on overlapping cluster shards.

Equal vectors of a label are one node. The nodes of each label are dealt to shards of bounded size: a larger shard is split
by its nearest pivots, a few of its own vectors, and every node goes to more than one of the parts. What pivots cannot
split, a dense group, is cut into hashed blocks, and every pair of blocks is a shard, so that no link inside is
lost. In each shard a graph is built by robust pruning; the adjacency lists of a node in all its shards are united. Then
each node is searched in each of its shards along the united graph: greedily from the medoids, then through everything in range. Each pair is
counted in the first shard that both its nodes are in, so links are summed in the tasks and never listed; components
come from one edge for each node and shard. A sample of nodes is compared with all others exactly; where the graph
missed too much, it is built again with more overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.batches import bounded_batches
from tidemark.llm.components import components
from tidemark.llm.flat_graph import BLOCK, Graph, medoids, pruned_neighbours, smallest_reachable, unit
from tidemark.llm.text import Shelf, smallest_hashes

LEAST = 0.93
#: Nodes of a shard, about; pivots of a split, at most; parts that a node goes to.
SHARD_ROWS, PIVOTS, OVERLAP = 8192, 64, 2
DEGREE, CANDIDATES, ALPHA, FAR = 16, 48, 1.2, 2
BEAM, MEDOIDS = 16, 8
#: Nodes that are held against all others, the recall they must show, and builds until they do.
AUDITED, LEAST_RECALL, MOST_BUILDS = 256, 0.97, 5
#: Nodes of a shard that are dealt to its parts in one task.
DEALT_ROWS = 8192


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return unit(values.reshape(len(flat), -1)) if len(flat) else np.zeros((0, 1))


def usable(vector: Column) -> Column:
    """Neither null nor empty, zero, or with a component that is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))


def apart(pivots: np.ndarray, least: float) -> np.ndarray:
    """Those pivots, in order, that are farther than twice the range from all taken before: others would split a dense group."""
    taken: list[int] = []
    for i, pivot in enumerate(pivots):
        if not taken or (pivots[taken] @ pivot).max() < 2 * least * least - 1:
            taken.append(i)
    return pivots[taken]


def _dealt(parts: pa.Table, pivots: pa.Table, overlap: int, least: float) -> pa.Table:
    """Members of a shard in the parts of their nearest pivots."""
    if not parts.num_rows:
        return pa.table({c: parts.column(c) for c in ("node", "size", "vector", "shard", "parent_n")})
    far = apart(_matrix(pivots.sort_by("place").column("vector")), least)
    close = _matrix(parts.column("vector")) @ far.T
    to = np.argsort(-close, axis=1, kind="stable")[:, :overlap]
    taken = parts.take(pa.array(np.repeat(np.arange(parts.num_rows), to.shape[1])))
    shard = parts.column("shard")[0].as_py()
    names = pa.array([f"{shard}.{i}" for i in to.ravel().tolist()])
    return pa.table({"node": taken.column("node"), "size": taken.column("size"), "vector": taken.column("vector"),
                     "shard": names, "parent_n": taken.column("n")})


def shards(nodes: DataFrame, shelf: Shelf, rows: int, overlap: int, least: float = LEAST) -> DataFrame:
    """(shard, node, size, vector): every node in each of its shards, of about `rows` nodes at most, from (group, node, size, vector)."""
    kind = nodes.schema["vector"].dataType.simpleString()
    schema = f"node long, size long, vector {kind}, shard string, parent_n long"
    open_ = nodes.select("node", "size", "vector", F.concat("group", F.lit("|")).alias("shard"), F.lit(None).cast("long").alias("parent_n"))
    done = []
    while True:
        sizes = open_.groupBy("shard").agg(F.count("*").alias("n"))
        open_ = shelf.put(open_.join(sizes, "shard"), "open")
        done.append(open_.filter(F.col("n") <= rows).select("shard", "node", "size", "vector"))
        large = open_.filter(F.col("n") > rows)
        if large.isEmpty():
            break
        # A part with more than half of its whole will not be split by pivots: blocks of half a shard, each with each.
        dense = large.filter(2 * F.col("n") > F.col("parent_n"))
        blocks = F.ceil(2 * F.col("n") / rows).cast("int")
        dense = dense.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        dense = dense.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        pair = F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other"))
        done.append(dense.select(F.concat("shard", F.lit("#"), pair).alias("shard"), "node", "size", "vector"))
        split = large.filter("parent_n is null or 2 * n <= parent_n")
        if split.isEmpty():
            break
        many = F.least(F.lit(PIVOTS), F.ceil(2.0 * overlap * F.col("n") / rows))
        salts = F.ceil(F.col("n") / DEALT_ROWS)
        pivots = smallest_hashes(split.select("shard", "node", "n", "vector"), "shard", ["node"], PIVOTS).filter(F.col("place") <= many)
        pivots = pivots.select("shard", "place", "vector", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)).alias("salt"))
        members = split.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(1)), salts).cast("long"))
        deal = lambda a, b: _dealt(a, b, overlap, least)
        open_ = members.groupBy("shard", "salt").cogroup(pivots.groupBy("shard", "salt")).applyInArrow(deal, schema)
        open_ = shelf.put(open_, "dealt")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _built(shard: pa.Table) -> pa.Table:
    shard = shard.sort_by("node")
    ids = shard.column("node").to_numpy()
    near = pruned_neighbours(_matrix(shard.column("vector")), DEGREE, CANDIDATES, ALPHA, FAR, len(ids))
    return pa.table({"node": ids, "shard": shard.column("shard"), "neighbours": pa.array([ids[x] for x in near], pa.list_(pa.int64()))})


def _searched(shard: pa.Table, least: float, beam: int) -> pa.Table:
    """Of each node of a shard how many vectors it links with in pairs that this shard counts, and its component's smallest node."""
    shard = shard.sort_by("node")
    ids, sizes, vectors = shard.column("node").to_numpy(), shard.column("size").to_numpy(), _matrix(shard.column("vector"))
    lists = shard.column("neighbours").combine_chunks()
    flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
    at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
    here = ids[at] == flat
    near = np.split(at[here], np.searchsorted(owner[here], np.arange(1, len(ids))))
    graph = Graph(vectors, near, medoids(vectors, MEDOIDS))
    # One byte for each pair of a shard: its rows are bounded.
    links = np.zeros((len(ids), len(ids)), bool)
    for a in range(0, len(ids), BLOCK):
        links[a : a + BLOCK] = graph.in_range(np.arange(a, min(len(ids), a + BLOCK)), least, beam)
    links |= links.T
    np.fill_diagonal(links, False)
    root = smallest_reachable(links)
    # Pairs that share an earlier shard are counted there.
    name, earlier = shard.column("shard")[0].as_py(), {}
    for i, others in enumerate(shard.column("shards").to_pylist()):
        for other in others:
            if other < name:
                earlier.setdefault(other, []).append(i)
    for both in earlier.values():
        links[np.ix_(both, both)] = False
    counts = np.concatenate([links[a : a + BLOCK] @ sizes for a in range(0, len(ids), BLOCK)])
    return pa.table({"node": ids, "links": counts, "root": ids[root]})


def _linked(nodes: DataFrame, shelf: Shelf, least: float, rows: int, overlap: int, beam: int) -> DataFrame:
    """(node, links, root) of each node and shard."""
    members = shelf.put(shards(nodes, shelf, rows, overlap, least), "members")
    built = members.groupBy("shard").applyInArrow(_built, "node long, shard string, neighbours array<long>")
    united = shelf.put(built, "built").groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"), F.collect_list("shard").alias("shards")
    )
    search = lambda shard: _searched(shard, least, beam)
    joined = members.join(united, "node").groupBy("shard")
    return shelf.put(joined.applyInArrow(search, "node long, links long, root long"), "linked")


def true_links(nodes: DataFrame, sample: list, least: float) -> dict[int, int]:
    """How many vectors each sampled node (group, node, vector) links with, by comparison with all nodes."""
    sent = nodes.sparkSession.sparkContext.broadcast(sample)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for group, node, vector in sent.value:
            known.setdefault(group, []).append((node, vector))
        asked = {g: (np.array([n for n, _ in k]), unit(np.array([v for _, v in k]))) for g, k in known.items()}
        for batch in batches:
            groups = np.array(batch.column("group").to_pylist(), object)
            for group in set(groups) & asked.keys():
                ids, vectors = asked[group]
                rows = np.flatnonzero(groups == group)
                part = batch.take(pa.array(rows))
                linked = vectors @ _matrix(part.column("vector")).T >= least
                linked &= ids[:, None] != part.column("node").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(linked @ part.column("size").to_numpy())], ["node", "links"])

    found = nodes.select("group", "node", "size", "vector").mapInArrow(compare, "node long, links long")
    return {r["node"]: r["links"] for r in found.groupBy("node").agg(F.sum("links").alias("links")).collect()}


def audited_recall(nodes: DataFrame, links: DataFrame, least: float, audited: int = AUDITED) -> float:
    """Share of the links of sampled nodes that were found: half of them any nodes, half nodes with links, by smallest hash."""
    joined = nodes.join(links, "node").select("group", "node", "vector", "links")
    some = joined.orderBy(F.xxhash64("node")).limit(audited // 2).collect()
    some += joined.filter("links > 0").orderBy(F.xxhash64("node", F.lit(1))).limit(audited // 2).collect()
    sample = {r["node"]: r for r in some}
    true = true_links(nodes, [(r["group"], r["node"], r["vector"]) for r in sample.values()], least)
    total = sum(true.values())
    return sum(min(r["links"], true[n]) for n, r in sample.items()) / total if total else 1.0


def embedding_dedup(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST,
    shard_rows: int = SHARD_ROWS,
    overlap: int = OVERLAP,
    beam: int = BEAM,
    audited: int = AUDITED,
) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors of one label link if their cosine, in double precision, is at least `least`. n_links counts the other rows
    linked directly, copies included; component_id is the smallest id that chains of links reach; kept rows are those whose id
    that is. A null label, a null, empty or zero vector, and one with null or not finite components link with
    nothing, and so do vectors of different length. Null ids are larger than all others. Ids may repeat; each row is a vector
    of its own. Other columns, whatever their names, are not looked at. Without rows the result is empty.

    Links are found by a graph, and each is verified; the audited recall of a sample must be `LEAST_RECALL`.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    shelf = Shelf(spark, "embedding-dedup")
    vector, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`").cast("string")
    group = F.when(usable(vector) & label.isNotNull(), F.concat_ws(":", F.length(label), label, F.size(vector)))
    given = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), vector.alias("vector"), group.alias("group"), F.monotonically_increasing_id().alias("tag")
    )
    given = shelf.put(given, "given")
    linkable = given.filter("group is not null")
    nodes = linkable.groupBy("group", "vector").agg(F.min("tag").alias("node"), F.count("*").alias("size"))
    nodes = shelf.put(nodes, "nodes")
    for build in range(MOST_BUILDS):
        found = _linked(nodes, shelf, least, shard_rows, overlap + build, beam << build)
        links = shelf.put(found.groupBy("node").agg(F.sum("links").alias("links")), "links")
        recall = audited_recall(nodes, links, least, audited)
        if recall >= LEAST_RECALL:
            break
    else:
        raise RuntimeError(f"the graph found {recall:.3f} of the sampled links after {MOST_BUILDS} builds")
    edges = found.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = shelf.put(components(edges, shelf), "roots").withColumnRenamed("root", "top")
    told = nodes.join(links, "node").join(roots, "node", "left").select(
        "group", "vector", F.coalesce("top", "node").alias("root"), (F.col("size") - 1 + F.col("links")).alias("n_links")
    )
    placed = linkable.join(told, ["group", "vector"]).select("vec_id", "n_links", "root")
    placed = shelf.put(placed, "placed")
    first = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    alone = given.filter("group is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = placed.join(first, "root").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
