import hashlib
import random
import re

import numpy as np
import xxhash

from tidemark.llm import golay, simhash
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.text import Shelf

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def small(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def brute_copies(rows):
    norm = [SPACES.sub(" ", r[1] or "") for r in rows]
    groups = {}
    for r, n in zip(rows, norm):
        groups.setdefault(n, []).append(r[0])
    return [(r[0], small(groups[n]), len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for r, n in zip(rows, norm)]


def check_copies(rows, got):
    told = [(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got]
    assert sorted(told, key=repr) == sorted(brute_copies(rows), key=repr)
    stay = [r for r in got if r["kept"]]
    assert sorted({r["text_sha256"] for r in got}) == sorted(r["text_sha256"] for r in stay)
    assert all(r["doc_id"] == r["keep_id"] for r in stay)


def test_exact_dedup_of_odd_rows(frame, odd_rows):
    check_copies(odd_rows, exact_dedup(frame(odd_rows)).collect())


def test_exact_dedup_carries_rows(frame, odd_rows):
    df = frame(odd_rows)
    kept = exact_dedup(df, carry=True).filter("kept").select("row.*")
    assert kept.columns == df.columns
    assert sorted(map(repr, kept.collect())) == sorted({SPACES.sub(" ", r["text"] or ""): repr(r) for r in sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]), reverse=True)}.values())


def test_groups_split_late_and_at_borders(frame):
    base = "s" * 4_000
    texts = [base, base, base[:-1] + "t", base[:64], base[:64], base[:63] + "t", base[:576], base[:575] + "t", base[:576]]
    rows = [(i, t, None, None) for i, t in enumerate(texts * 3)]
    check_copies(rows, exact_dedup(frame(rows), first_bytes=64, growth=8).collect())
    check_copies(rows, exact_dedup(frame(rows), first_bytes=1, growth=2).collect())


def test_ids_that_stand_for_several_texts(frame):
    rows = [(7, "one", None, None), (7, "two", None, None), (7, "one", None, None), (None, "two", None, None)]
    check_copies(rows, exact_dedup(frame(rows)).collect())


def test_golay_keys_stand_two_errors():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 3000)
    y = x.copy()
    for _ in range(2):
        y ^= np.where(rng.random(3000) < 0.8, 1 << rng.integers(0, 23, 3000), 0)
    (a, n), (b, m) = golay.nearby_indices(x), golay.nearby_indices(y)
    assert set(n) <= {1, 6}
    assert all(set(p[:i]) & set(q[:j]) for p, i, q, j in zip(a.tolist(), n, b.tolist(), m))


def test_every_pair_of_four_errors_shares_a_key():
    rng = random.Random(3)
    for _ in range(400):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 4):
            y ^= 1 << bit
        at, keys = simhash.candidate_keys(np.array([x, y], np.uint64))
        assert set(keys[at == 0].tolist()) & set(keys[at == 1].tolist())


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    flat, roots = np.array(sorted(set(prints)), np.uint64), {}
    parent = list(range(len(flat)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(flat)):
        for j in (np.flatnonzero(np.bitwise_count(flat[i + 1 :] ^ flat[i]) <= 4) + i + 1).tolist():
            parent[find(i)] = find(j)
    for i, p in enumerate(flat.tolist()):
        roots[p] = find(i)
    return roots


def test_near_dedup_of_odd_rows(frame, odd_rows):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=300)
    rows = list(odd_rows)
    for i in range(60):
        near = list(base)
        near[rng.randrange(300)] = "new"
        rows.append((100 + i, " ".join(near), "en", "a"))
        rows.append((200 + i, " ".join(rng.choices(words, k=30)), "en", "a"))
    got = simhash.near_dedup(frame(rows), carry=True).collect()
    prints = {r[1]: brute_print(r[1]) for r in rows}
    roots = brute_roots(prints.values())
    ids = {}
    for r in rows:
        ids.setdefault(roots[prints[r[1]]], []).append(r[0])
    wanted = [(r[0], f"{prints[r[1]]:016x}", small(ids[roots[prints[r[1]]]])) for r in rows]
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == sorted(wanted, key=repr)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(ids) and all(r["doc_id"] == r["component_id"] == r["row"]["doc_id"] for r in kept)


def test_keys_with_many_members_lose_no_link(spark):
    rng = random.Random(11)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(150):
            near = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                near ^= 1 << bit
            prints.add(near)
        # A chain that leaves the cluster step by step.
        for step in range(0, 24, 3):
            centre ^= 0b111 << step
            prints.add(centre)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p,) for p in signed], "print long")
    shelf = Shelf(spark, "test")
    roots = {r["node"] % (1 << 64): r["root"] for r in simhash.linked(classes, shelf, 4).collect()}
    wanted = brute_roots(prints)
    mine, theirs = {}, {}
    for p in prints:
        mine.setdefault(roots.get(p, p), set()).add(p)
        theirs.setdefault(wanted[p], set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5), (2000, -3)]
    shelf = Shelf(spark, "test")
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), shelf).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(60)}, 2000: -3, -3: -3}


def test_empty_tables(frame):
    assert exact_dedup(frame([])).count() == 0
    assert simhash.near_dedup(frame([])).count() == 0
