import time

import numpy as np
import pytest

from tidemark.llm import html, quality, simhash
from tidemark.llm.batches import white_blocks

LONG = (" ".join(f"Word{i % 7919} übung {i % 13} THE" for i in range(60_000)) + "  \t end end").encode()


@pytest.mark.parametrize("size", [1, 7, 1000, 1 << 20, 1 << 30])
def test_blocks_hold_all_words(size):
    text = LONG if size > 100 else LONG[:5000]
    parts = list(white_blocks(text, size))
    assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()
    assert list(white_blocks(b"", size)) == [b""]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 400])
def test_fingerprints_in_blocks(n):
    text = b" ".join(LONG.split()[:n])
    assert simhash.long_fingerprint(text, 4, 42, 50) == simhash.fingerprints([text])[0]


def test_long_and_short_texts_together():
    texts = [b"a b c d e f", LONG, b"", b"x"]
    assert len(LONG) > simhash.BLOCK_BYTES
    alone = [simhash.fingerprints([t])[0] for t in texts]
    assert simhash.fingerprints(texts).tolist() == alone


def test_terms_of_a_long_text_are_bounded():
    columns, weights = quality.Terms(512).of(LONG)
    assert len(columns) == len(set(columns.tolist())) <= 512 and len(weights) == len(columns) and np.isfinite(weights).all()


def test_scan_is_linear_in_a_text(spark):
    import public_tokenizers

    from tidemark.llm import secrets

    scanner = secrets.Scanner(
        secrets.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, secrets.LEAST_RATIO, secrets.LEAST_CHARS
    )
    line = "commit 0123456789abcdef0123456789abcdef01234567 of the-build-number-one\n"
    start = time.time()
    spans = scanner.spans(line * 40_000)
    assert len(spans) == 40_000 and {s[0] for s in spans} == {"hex"} and time.time() - start < 20


def test_leading_vectors_and_votes_agree_with_the_whole_decomposition():
    rng = np.random.default_rng(0)
    rows = rng.standard_normal((60, 200)).astype(np.float32) * np.linspace(3, 0.1, 200, dtype=np.float32)
    gram = rows @ rows.T
    values, vectors = quality.leading(gram, 5)
    true = np.linalg.eigvalsh(gram.astype(np.float64))[::-1][:5]
    assert np.allclose(values, true, rtol=1e-3)
    assert np.allclose(gram @ vectors, vectors * values, atol=2e-2 * values[0])


def test_votes_equal_plain_cosines():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(words[:25] if i % 2 else words[15:], 30)).encode() for i in range(50)]
    terms = [quality.Terms(2048).of(t) for t in texts]
    labels = np.array([i % 2 for i in range(40)], float)
    model = quality.fit(terms[:40], labels, 2048, 10)
    dense = np.zeros((50, 2048))
    for i, (at, w) in enumerate(terms):
        np.add.at(dense[i], at, quality._balanced(at, w, model.rarity))
    vectors = dense @ model.space
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    for i, score in enumerate(quality.vote(terms, model, 5, 8)):
        cosines = vectors[:40] @ vectors[i]
        near = np.argsort(-cosines)[:5]
        weights = np.maximum(cosines[near], 0) ** 8
        assert abs(score - (weights * labels[near]).sum() / weights.sum()) < 1e-3


COMMENTS = [
    "<article><h1>T</h1><p>Body of it.</p><ol><li><article class='comment'><p>reader says</p></article></li></ol></article>",
    "<article><h1>T</h1><p>Body of it.</p></article><section><article class='user-comment'><p>reader says</p></article></section>",
]


@pytest.mark.parametrize("page", COMMENTS)
def test_comments_marked_up_as_articles_go(spark, page):
    pages = spark.createDataFrame([(1, "http://a.example/1", page)], "page_id long, url string, html string")
    assert html.extract_text(pages).first()["text"] == "T Body of it."


def test_a_paragraph_far_up_ends():
    inner = "".join(f"<span class='comment'>" for _ in range(9))
    root = html.parse(f"<div><p>one {inner}two<div>three</div></div>")
    paragraph = root.children[0].children[0]
    assert paragraph.key == "p" and all(isinstance(c, str) or c.key != "div" for c in paragraph.children)
