import base64
import hashlib
import os
import re

import public_tokenizers
import pytest
import tiktoken
import xxhash

import __spark_entry__ as registered
import corpus_pipeline
from check import duck, same
from tidemark.llm import quality
from tidemark.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason=f"no test tables at {SF}")


def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows_of(spark, name):
    return registered.queries()[name](spark, SF).collect()


def test_names():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in registered.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert same(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == ""


@pytest.mark.parametrize("name, column, truth", [("op4_quality", "predicted", "quality"), ("op6_language", "lang_pred", "lang")])
def test_held_out_accuracy(spark, name, column, truth):
    if truth == "quality":
        known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    else:
        known = {i: r["lang"] for i, r in documents(spark).items()}
    got = rows_of(spark, name)
    assert len(got) == len(documents(spark))
    held = [r[column] == known[r["doc_id"]] for r in got if r["held_out"] and known.get(r["doc_id"]) is not None]
    assert sum(held) / len(held) > 0.9


def test_html_text_is_the_article(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows_of(spark, "op9_html_text"):
        article = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        blocks = (html.unescape(re.sub("<[^>]*>", "", b)).split() for b in re.split("</?(?:p|h1|br)>", article))
        assert r["text"] == " ".join(" ".join(b) for b in blocks if b) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("name", ["op1_token_counts", "op3_secret_scan", "op7_simhash_near_dedup", "op8_byte_bpe"])
def test_one_row_for_each_document(spark, name):
    assert sorted(r["doc_id"] for r in rows_of(spark, name)) == sorted(documents(spark))


def fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_pipeline_equals_brute_force(spark):
    """All stages but the classifier's votes are done again in plain Python."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    votes = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, labels).collect()}
    kept = [r for i, r in sorted(documents(spark).items()) if votes[i]]
    seen: dict[str, object] = {}
    for r in kept:
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), r)
    kept, prints, first = list(seen.values()), [], []
    prints = [fingerprint(r["text"] or "") for r in kept]
    parent = list(range(len(kept)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(kept)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    first = [r for i, r in enumerate(kept) if find(i) == i]
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in first}
    by_source: dict[str, list] = {}
    for r in first:
        h = int(hashlib.md5(f"{r['doc_id']}\n{r['text'] or ''}".encode()).hexdigest()[:15], 16)
        by_source.setdefault(r["source"], []).append((h, r))
    order = sorted(s for s in by_source if s is not None) + [None] * (None in by_source)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    sums = {s: sum(size[r["doc_id"]] for _, r in by_source[s]) for s in order}
    stopped: set = set()
    while True:
        unit = (sum(sums.values()) - sum(3 * sums[s] for s in stopped)) / sum(weight[s] for s in order if s not in stopped)
        above = {s for s in order if s not in stopped and unit * weight[s] >= 3 * sums[s]}
        if not above:
            break
        stopped |= above
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = []
    for s in order:
        target = 3.0 * sums[s] if s in stopped else unit * weight[s]
        base = int(target // sums[s]) if sums[s] else 0
        left, before, ended = target - base * sums[s], 0, False
        for _, r in sorted(by_source[s], key=lambda x: x[0]):
            n = size[r["doc_id"]]
            fits = before + n <= left or not ended and 2 * (left - before) >= n
            ended |= before + n > left
            before += n
            ids = encoding.encode_ordinary(r["text"] or "")
            wanted += [(r["doc_id"], ids)] * min(3, base + fits)
    got = corpus_pipeline.run(spark, SF)
    rows = got.collect()
    assert sorted((r["doc_id"], r["ids"]) for r in rows) == sorted(wanted)
    text = {i: r["text"] or "" for i, r in documents(spark).items()}
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
