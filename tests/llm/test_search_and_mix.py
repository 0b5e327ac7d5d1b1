import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import mixing, top_k


def brute_top(rows, k, every):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(kept):
        if q % every == 0:
            scored = [(sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(kept) if m != n]
            best = sorted(scored, key=lambda s: (-s[0], s[1]))[:k]
            out += [(q, r, i, s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows, query_rows", [(1024, 2048), (16, 3)])
def test_top_k_equals_brute_force(spark, block_rows, query_rows):
    rng = np.random.default_rng(3)
    rows = [(i, [round(float(x), 2) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [(0, rows[0][1]), (10, rows[5][1])]
    rows += [(400, None), (410, [1.0, None]), (420, [float("nan")] * 6), (430, [float("inf")] * 6), (None, rows[1][1]), (440, [1.5]), (450, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, row int, vector string")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = top_k.exact_top_k(df, k=5, every=10, block_rows=block_rows, query_rows=query_rows)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 10)


def test_top_k_of_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k.exact_top_k(df).collect())) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert top_k.exact_top_k(df.limit(1)).count() == 0
    assert top_k.exact_top_k(df.limit(0)).count() == 0


def test_search_stops_early():
    rng = np.random.default_rng(4)
    vectors = np.zeros((2000, 4), np.int64)
    vectors[:, 0] = np.arange(2000)
    vectors[:, 1:] = rng.integers(0, 3, (2000, 3))

    ids = np.arange(2000)
    _, at, score = top_k.threshold_search(vectors, ids, ids, np.array([[9, 1, 0, -1]]), np.array([-1]), 5)
    exact = vectors @ np.array([9, 1, 0, -1])
    assert score.tolist() == sorted(exact.tolist(), reverse=True)[:5] and exact[at].tolist() == score.tolist()


def words(text):
    return len((text or "").encode().split())


def test_mix_meets_its_targets(frame):
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(0, 30)), None, ["é", "tiny", "c", None, "b"][min(4, int(rng.integers(0, 40)) // 9)]) for i in range(3000)]
    got = mixing.mix(frame(rows)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += words(r[1])
    total, order = sum(sizes.values()), sorted((s for s in sizes if s is not None)) + [None]
    weight, stopped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        unit = (total - sum(3 * sizes[s] for s in stopped)) / sum(weight[s] for s in order if s not in stopped)
        above = {s for s in order if s not in stopped and unit * weight[s] > 3 * sizes[s]}
        if not above:
            break
        stopped |= above
    target = {s: 3 * sizes[s] if s in stopped else unit * weight[s] for s in order}
    source, taken = {r[0]: r[3] for r in rows}, Counter()
    for r in got:
        assert r["size"] == words(rows[r["doc_id"]][1]) and r["source_size"] == sizes[source[r["doc_id"]]]
        assert math.isclose(r["target"], target[source[r["doc_id"]]]) and r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert stopped and len(got) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 30 for s in order)
    again = mixing.mix(frame(rows[::-1]).repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_of_odd_rows(frame, odd_rows):
    df = frame(odd_rows)
    got = mixing.mix(df, carry=True).collect()
    assert Counter(words(r[1]) for r in odd_rows) == Counter(r["size"] for r in got)
    assert sorted(repr(r["row"]) for r in got) == sorted(map(repr, df.collect()))
    assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in got)


def test_mix_of_nothing(frame):
    assert mixing.mix(frame([])).count() == 0
    assert [r["taken"] for r in mixing.mix(frame([(1, "", None, "a"), (2, None, None, None)])).collect()] == [0, 0]
