"""Token counts of whole texts, one text at a time."""

import os

import pytest

from smeltery.llm import token_rollup


@pytest.mark.skipif(not os.path.isdir(token_rollup.TOKENIZERS), reason="vocabularies are not here")
def test_texts_are_counted_whole_and_null_as_empty(spark):
    texts = ["one two three", None, "", "é 漢字 \U0001f600", "word " * 5000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    encode = token_rollup._encoding(token_rollup.TOKENIZERS, "byte_bpe_50k").encode_ordinary
    got = token_rollup.counted(docs, "byte_bpe_50k").collect()
    assert {r.doc_id: r.tokens for r in got} == {i: len(encode(t or "")) for i, t in enumerate(texts)}
