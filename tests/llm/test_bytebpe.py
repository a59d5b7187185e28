import base64
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conceptloom.llm.bytebpe import DEFAULT_VOCABULARY, Encoder
from conceptloom.llm.encoding import count_tokens, decode_corpus, encode_corpus

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(DEFAULT_VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return Encoder()


def split(encoder, texts):
    ids, sizes = encoder.encode(texts)
    out, at = [], 0
    for n in sizes:
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_random_mixtures_equal_the_reference_encoder(encoder, reference):
    rng = random.Random(11)
    bits = ["'", "s", "re", "'ll", " ", "  ", "\n", "\r\n", "\t", "don't", "42", "½", "é", "中文", "の", "。", "🧵", "﻿", "ไทย", "\x1c", "\x85", "́", "　", "<|endoftext|>"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(40))) for _ in range(3000)] + ["a" * 4000, "中" * 3000, "=" * 3000, "", " "]
    assert split(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), max_size=4))
def test_any_text(encoder, reference, texts):
    assert split(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


def test_corpus_round_trip(spark):
    texts = ["Plain text, isn't it?", "中文與 English 混合", None, "", "  \n", "word " * 5000, "word " * 5000]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    encoded = encode_corpus(docs)
    rows = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert rows[2] == [] and rows[3] == []
    back = {r["doc_id"]: (r["text"], r["byte_offsets"]) for r in decode_corpus(encoded).collect()}
    assert all(back[i][0] == (t or "") for i, t in enumerate(texts))
    assert back[1][1][0] == 0 and len(back[1][1]) == len(rows[1])
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs).collect()} == {i: len(v) for i, v in rows.items()}
    assert encode_corpus(docs.limit(0)).count() == 0
