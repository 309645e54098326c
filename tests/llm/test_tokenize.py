"""Token ids against the public library, and the defined cases."""

import random

import pytest
from tokenizers import Tokenizer

from paperloom.llm.tokenize import VOCABULARY, token_ids


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_equals_library_on_documents(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    want = {r.doc_id: library(r.text) for r in docs.collect()}
    got = {r.doc_id: r.ids for r in token_ids(docs).collect()}
    assert got == want


def test_defined_cases(spark, library):
    random.seed(5)
    bits = ["a", " ", "\n", "\t", "  ", "1", "'s", ".", "é", " ", "　", "\x1c", "Wort", "漢字"]
    texts = [None, "", " ", " a ", "a\n ", "<|endoftext|>", "aaaaaaa", "word " * 20000] + ["".join(random.choices(bits, k=random.randint(1, 12))) for _ in range(500)]
    rows = [(i, t, "x", i) for i, t in enumerate(texts)] + [(0, None, "x", 0), (None, "a b", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")
    got = token_ids(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in got) == sorted((i is None, i or 0, library(t)) for i, t, *_ in rows)
    assert token_ids(df.limit(0)).collect() == []
