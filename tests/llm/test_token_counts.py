"""Suffix sums against plain sums, the histogram against encoding every text, and a second encoder."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

from shelfcast.llm import catalog
from shelfcast.llm import token_counts as K


@pytest.fixture(scope="module")
def encode():
    return K.encoder(Path(K.VOCABULARY).read_bytes()).encode_ordinary


def check(df, lengths):
    got = {r["n_tokens"]: r for r in df.collect()}
    assert set(got) == set(lengths)
    for n, row in got.items():
        assert row["n_docs"] == lengths.count(n)
        assert row["docs_at_least"] == sum(x >= n for x in lengths)
        assert row["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert row["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert row["share_at_most"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))


def test_odd_texts(spark, encode):
    texts = [None, "", "a", "a", "hello world " * 400, "\U0001f600 ñ <|endoftext|>", " \n\t "]
    docs = spark.createDataFrame([(t, 1, 2) for t in texts], "text string, n_tokens int, n_docs int")
    sums = K.suffix_sums(K.length_histogram(docs))
    lengths = [len(encode(t)) if t else 0 for t in texts]
    check(sums, lengths)
    for limit in (0, 1, 2, 500, 10_000):
        assert K.truncated_total(sums, limit) == sum(min(x, limit) for x in lengths)
    assert K.quantile(sums, 0.5) == sorted(lengths)[3] and K.quantile(sums, 1.0) == max(lengths)
    empty = K.suffix_sums(K.length_histogram(docs.limit(0)))
    assert empty.collect() == [] and K.truncated_total(empty, 5) == 0 and K.quantile(empty, 0.5) is None


def test_long_lengths_cross_the_digits(spark):
    lengths = [k * 997 % 5_000_000 for k in range(800)] + [2**21] * 3
    df = spark.createDataFrame(sorted(Counter(lengths).items()), "n_tokens long, n_docs long")
    check(K.suffix_sums(df), lengths)


def test_a_second_encoder_agrees(encode):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(str(Path(K.VOCABULARY).with_name("byte_bpe_50k.json")))
    for text in ("Thnt it's the  end.\n\n12345 ñandú", "a" * 300):
        assert encode(text) == other.encode(text, add_special_tokens=False).ids


def test_query_equals_encoding_every_text(spark, folder, encode):
    rows = catalog.table(spark, folder, "documents").collect()
    check(catalog.QUERIES["op5_token_counts"](spark, folder), [len(encode(r["text"] or "")) for r in rows])
