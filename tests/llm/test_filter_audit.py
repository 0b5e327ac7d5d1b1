import random
import re
from collections import Counter
from itertools import permutations

import pytest

from tidemark.llm import filter_audit as f

SPACES = re.compile("[\x20\x09-\x0d]+")


def failing(rows):
    """Per row its part, flags and the letters it fails."""
    lowest = {}
    for r in rows:
        i = f.BEYOND if r[0] is None else r[0]
        lowest[r[1] or ""] = min(i, lowest.get(r[1] or "", i))
    for doc_id, text, lang, _ in rows:
        text = text or ""
        words = [w for w in SPACES.split(text) if w]
        caps = len(re.findall("[A-Z]", text))
        tests = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * caps > 3 * len(text),
                 bool(re.search("[#$%&*|]", text)), lowest[text] < (f.BEYOND if doc_id is None else doc_id)]
        yield doc_id, lang or "", {x for x, t in zip("ABCDE", tests) if t}


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    told = list(failing(rows))
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for i, x in enumerate(order):
            before = set(order[:i])
            for part in {p for _, p, _ in told}:
                n = Counter()
                for doc_id, p, fails in told:
                    if p != part:
                        continue
                    gone, fail = bool(fails & before), x in fails
                    n["kept"] += not gone and not fail
                    n["removed"] += not gone and fail
                    n["redundant"] += gone and fail
                    n["unique"] += fails == {x}
                    n["good"] += not gone and fail and doc_id in good
                    n["toxic"] += not gone and fail and doc_id in toxic
                out[part, order, i + 1] = [n[k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic")]
    shapley = Counter()
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] += row[1]
    return sorted((*k, *row, shapley[k[0], k[1][k[2] - 1]]) for k, row in out.items())


def got(df):
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def stored(df, path, files):
    """The rows in files of which each is one of `files` lists, in that order of arrival."""
    for i, rows in enumerate(files):
        df(rows).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


LABELS = "doc_id long, quality int, toxic int, text string"


def test_smaller_ids_that_come_later_are_retracted(spark, frame, odd_rows, tmp_path):
    rng = random.Random(4)
    long_text = " ".join(f"w{i}" for i in range(300))
    texts = [long_text, long_text + " A" * 40, "short text", "SHOUTING |", "a b " * 200, "", None]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", None, ""]), None) for _ in range(120)]
    rows.sort(key=lambda r: -1 if r[0] is None else -r[0])
    files = [rows[i : i + 30] for i in range(0, 120, 30)] + [odd_rows]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in [*range(0, 40, 2), None, 4, 999]]
    path = stored(frame, tmp_path / "documents.parquet", files)
    df = f.audit_filters(spark, path, spark.createDataFrame(labels, LABELS), files_per_batch=1, buckets=3)
    everything = [r for rows in files for r in rows]
    assert got(df) == brute(everything, [r[:3] for r in labels])


def test_empty_tables(spark, frame, tmp_path):
    path = stored(frame, tmp_path / "documents.parquet", [[(1, "a", "en", None)]])
    empty = str(tmp_path / "none.parquet")
    spark.read.parquet(path).filter("false").write.parquet(empty)
    labels = spark.createDataFrame([], LABELS)
    assert f.audit_filters(spark, empty, labels).collect() == []
    rows = f.audit_filters(spark, path, labels).collect()
    assert len(rows) == 600 and all(r["good_lost"] == r["toxic_lost"] == 0 for r in rows)


def merged(kinds, texts):
    out = f.Copies()
    for i, k in zip(texts, kinds):
        out.add(i, k)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_changes_sum_to_the_whole_in_any_order(seed):
    rng = random.Random(seed)
    ids = [rng.randrange(6) for _ in range(30)]
    kinds = [(rng.choice("ab"), rng.random() < 0.5, False) for _ in ids]
    state, sums = None, Counter()
    for at in range(0, 30, 5):
        state, out = f.changes(state, merged(kinds[at : at + 5], ids[at : at + 5]), 3)
        for mask, kind, n in out:
            sums[mask, kind] += n
    wanted = Counter((3 if i == min(ids) else 3 | f.COPY, k) for i, k in zip(ids, kinds))
    assert {k: n for k, n in sums.items() if n} == dict(wanted)


def test_words_of_long_texts():
    text = (" ".join(f"w{i % 700}" for i in range(5000)) + "\t\n x" * 3).encode()
    assert f.counted_words(text, 100) == (len(text.split()), len(set(text.split()))) == f.counted_words(text)
    assert f.counted_words(b" " * 500, 100) == (0, 0) == f.counted_words(b"", 1)
