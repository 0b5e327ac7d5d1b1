import numpy as np
import pytest

from tidemark.llm import embedding_dedup as d
from tidemark.llm import flat_graph
from tidemark.llm.text import Shelf

SCHEMA = "vec_id long, embedding array<double>, label int, node long, size long, shard string, root string, vector string, n_links int"
CLASH = (7, 7, "s", "r", "v", 7)


def brute(rows, least=0.93):
    """(vec_id, n_links, component_id, kept) of each row, and whether it can link at all."""
    ok = [
        r[2] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(x != 0 for x in r[1])
        for r in rows
    ]
    unit = [np.array(r[1]) / np.abs(r[1]).max() if o else None for r, o in zip(rows, ok)]
    unit = [u / np.sqrt(u @ u) if u is not None else None for u in unit]
    link = lambda i, j: ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least
    n = len(rows)
    links = np.array([[i != j and link(i, j) for j in range(n)] for i in range(n)]).reshape(n, n)
    order = sorted(range(n), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    roots = flat_graph.smallest_reachable(links[np.ix_(order, order)]) if n else []
    small = {order[i]: rows[order[r]][0] for i, r in enumerate(roots)}
    return sorted(((r[0], int(links[i].sum()), small[i], r[0] == small[i]) for i, r in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r[k] for k in ("vec_id", "n_links", "component_id", "kept")) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], 1), (3, [2.0, 0.1, 0.0], 1), (2, [1.0, 0.0, 0.0], 2),
        (None, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 0.0], 1),
        (9, [inf, 0.0, 0.0], 1), (10, [None, 1.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.0], 1), (13, [1e300, 1e298, 0.0], 1),
        (14, [1e-300, 0.0, 0.0], 1), (14, [1e-300, 0.0, 0.0], 1), (15, [-1.0, 0.0, 0.0], 1), (None, None, None), (None, [0.0, 1.0], 7),
    ]
    assert got(d.embedding_dedup(table(spark, rows))) == brute(rows)
    assert got(d.embedding_dedup(table(spark, rows[:1]).filter("false"))) == []


def clustered(seed, n, dims=16):
    """One dense group of a third of all rows, small groups, exact copies and singles, over three labels."""
    rng = np.random.default_rng(seed)
    rows, centre = [], rng.standard_normal(dims)
    for i in range(n):
        kind = i % 3
        if kind == 0:
            vector, label = centre + 0.03 * rng.standard_normal(dims), 1
        elif kind == 1:
            vector, label = np.random.default_rng(i // 12).standard_normal(dims) + 0.05 * rng.standard_normal(dims), int(i // 12 % 3)
        else:
            vector, label = rng.standard_normal(dims), int(rng.integers(3))
        rows.append((n - i, vector.tolist(), label))
    return rows + [(1000 + i, r[1], r[2]) for i, r in enumerate(rows[:9])]


@pytest.mark.parametrize("shard_rows", [2048, 40])
def test_equals_brute_force(spark, shard_rows):
    rows = clustered(1, 300)
    found = got(d.embedding_dedup(table(spark, rows), shard_rows=shard_rows, overlap=2))
    wanted = brute(rows)
    assert [r[0] for r in found] == [r[0] for r in wanted]
    short = sum(w[1] - f[1] for f, w in zip(found, wanted))
    assert all(f[1] <= w[1] for f, w in zip(found, wanted)) and short <= 0.03 * sum(w[1] for w in wanted)
    if shard_rows > len(rows):
        assert found == wanted


def test_shards_are_bounded_and_hold_every_node(spark):
    rows = clustered(2, 400)
    nodes = spark.createDataFrame([("g", i, 1, r[1]) for i, r in enumerate(rows)], "group string, node long, size long, vector array<double>")
    dealt = d.shards(nodes, Shelf(spark, "test"), 50, 2).toPandas()
    assert set(dealt["node"]) == set(range(len(rows))) and dealt.groupby("shard").size().max() <= 100
    assert not dealt.duplicated(["shard", "node"]).any()
    # Two nodes of a dense part that is cut into blocks share a shard.
    blocks = dealt[dealt["shard"].str.contains("#")]
    for part in set(blocks["shard"].str.split("#").str[0]):
        mine = blocks[blocks["shard"].str.startswith(part + "#")].groupby("node")["shard"].agg(set)
        assert all(a & b for a in mine for b in mine)


def test_search_finds_what_is_in_range():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 32))
    vectors = flat_graph.unit(np.repeat(centres, 8, axis=0) + 0.1 * rng.standard_normal((480, 32)))
    near = flat_graph.pruned_neighbours(vectors, 16, 48, 1.2, 2, 0)
    assert all(i not in x and len(set(x)) == len(x) for i, x in enumerate(map(list, near)))
    graph = flat_graph.Graph(vectors, near, flat_graph.medoids(vectors, 8))
    hits = graph.in_range(np.arange(480), 0.9, 16)
    true = vectors @ vectors.T >= 0.9
    assert not (hits & ~true).any() and hits.sum() >= 0.99 * true.sum()


def test_pruning_keeps_the_nearest_and_drops_what_it_covers():
    angles = np.array([0, 0.1, 0.5, -0.3])
    points = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    near = flat_graph.pruned_neighbours(points, 3, 3, 1.2, 0, 0)
    assert 1 in near[0] and 2 not in near[0] and 3 in near[0]


def test_audit_counts_what_was_missed(spark):
    rows = clustered(4, 120)
    nodes = spark.createDataFrame([("g", i, 1, r[1]) for i, r in enumerate(rows[:120])], "group string, node long, size long, vector array<double>")
    unit = flat_graph.unit(np.array([r[1] for r in rows[:120]]))
    true = (unit @ unit.T >= d.LEAST).sum(axis=1) - 1
    links = lambda n: spark.createDataFrame([(i, int(x)) for i, x in enumerate(n)], "node long, links long")
    assert d.audited_recall(nodes, links(true), d.LEAST) == 1.0
    assert d.audited_recall(nodes, links(true // 2), d.LEAST) < 0.6
