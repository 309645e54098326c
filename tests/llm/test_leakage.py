"""Leaked passages against planted cases and a plain aligner."""

import random

import numpy as np
import pytest

from paperloom.llm.leakage import Hashes, ItemIndex, batch_of, leaked_items, normal_tokens, normal_word


def words(n, rng):
    return [rng.choice(["the", "of", "invoice", "page", "order", "was", "copied", "from"]) if rng.random() < 0.6 else "".join(rng.choices("abcdefgik", k=6)) for _ in range(n)]


def aligned(item, text, least=24, tolerance=8):
    """Plain aligner: is there a span of the item, ``least`` words or more, with an edit in ``tolerance`` words at most?"""
    n, m = len(item), len(text)
    differs = np.array([[a != b for b in text] for a in item])
    for start in range(n - least + 1):
        row = np.zeros(m + 1, int)  # edits of item[start:i] against a stretch of the text that ends at j
        for i in range(start, n):
            new = np.empty(m + 1, int)
            new[0] = row[0] + 1
            new[1:] = np.minimum(row[:-1] + differs[i], row[1:] + 1)
            row = np.minimum.accumulate(new - np.arange(m + 1)) + np.arange(m + 1)
            if i - start + 1 >= least and row.min() * tolerance <= i - start + 1:
                return True
    return False


def test_planted(spark):
    rng = random.Random(4)
    items = [(i, words(60, rng)) for i in range(40)]
    filler = lambda: " ".join(words(120, rng))
    docs, want = [], set()

    def plant(passage, item=None):
        docs.append((len(docs), f"{filler()} {passage} {filler()}"))
        if item is not None:
            want.add((item, len(docs) - 1))

    for i, w in items:
        plant(" ".join(w[10:34]).upper(), i)
        plant(" ".join(w[5:17]))  # too short
        edited = list(w[20:52])
        for k in (3, 12, 20, 29):
            edited[k] = "changed"
        plant("\n".join(edited), i)
        middle = list(w[20:52])  # all edits in what every part of 24 words has
        for k in (12, 14, 16, 18):
            middle[k] = "changed"
        plant("\n".join(middle), i)
        added = w[:15] + ["extra"] + w[15:22] + w[23:30]
        plant(", ".join(added), i)
        plant(" ".join(x if k % 4 else "other" for k, x in enumerate(w)))  # too many changes
    w = items[3][1]
    plant(" ".join(w[:8]) + " " + w[8][:3] + "-\n" + w[8][3:] + " " + " ".join(w[9:30]).replace("a", "а"), 3)
    docs += [(9000, None), (9001, ""), (9002, docs[0][1]), (9002, docs[0][1])]
    want.add((0, 9002))
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    e = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items] + [(100, None, None), (101, "", None), (102, "short text", None)], "item_id long, text string, task string")
    got = [(r.item_id, r.doc_id) for r in leaked_items(d, e).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert leaked_items(d.limit(0), e).collect() == [] and leaked_items(d, e.limit(0)).collect() == []
    named = e.selectExpr("concat('item ', item_id) as item_id", "text")
    parted = [(r.item_id, r.doc_id) for r in leaked_items(d, named, most_units=9).collect()]
    assert len(parted) == len(want) and set(parted) == {(f"item {i}", k) for i, k in want}


def test_refrains(spark):
    """Quotations with hardly any distinct shingles are found too."""
    rng = random.Random(8)
    refrain = "row row row your boat".split()
    items = [refrain * 12, words(20, rng) + refrain * 5 + words(20, rng), "one two".split() * 30]
    docs = [items[0][:30], items[0][:40], items[1][20:44], items[2][:24], items[0][:20]]
    d = spark.createDataFrame([(i, " ".join(words(30, rng) + t + words(30, rng))) for i, t in enumerate(docs)], "doc_id long, text string")
    e = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id int, text string")
    got = {(r.item_id, r.doc_id) for r in leaked_items(d, e).collect()}
    assert got == {(0, 0), (0, 1), (1, 2), (0, 2), (1, 0), (1, 1), (2, 3)}


@pytest.mark.parametrize("seed", range(3))
def test_edited_passages_against_the_aligner(seed):
    """Retrieval loses no edited passage that the plain aligner accepts, and verification accepts no other."""
    rng = random.Random(seed)
    items = [words(rng.choice([45, 60, 150]), rng) for _ in range(10)]
    texts = []
    for _ in range(24):
        w = rng.choice(items)
        n = rng.randint(20, 48)
        s = rng.randrange(max(1, len(w) - n))
        part = w[s : s + n]
        for _ in range(rng.randint(0, len(part) // 8 + 1)):
            k = rng.randrange(len(part))
            part[k : k + 1] = rng.choice([[], ["swap"], [part[k], "more"]])
        texts.append(words(rng.randint(0, 60), rng) + part + words(rng.randint(0, 60), rng))
    index, hashes = ItemIndex([(i, " ".join(w)) for i, w in enumerate(items)], 24, 8), Hashes()
    got = {(index.ids[u], k) for k, u in index.leaked(*batch_of([hashes.of(" ".join(t)) for t in texts]))}
    assert got == {(i, k) for i, w in enumerate(items) for k, t in enumerate(texts) if aligned(w, t)}


def test_retrieval_loses_nothing(spark, data):
    """Every pair with a long common run is retrieved and verified on the data."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/eval_items.parquet").collect()]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {(r.item_id, r.doc_id) for r in leaked_items(docs, spark.read.parquet(f"{data}/eval_items.parquet")).collect()}
    runs = {}
    for i, t in items:
        w = [n for x in normal_tokens(t) if (n := normal_word(x))]
        for k in range(len(w) - 23):
            runs.setdefault(tuple(w[k : k + 24]), set()).add(i)
    want = set()
    for r in docs.collect():
        w = [n for x in normal_tokens(r.text or "") if (n := normal_word(x))]
        for k in range(len(w) - 23):
            want |= {(i, r.doc_id) for i in runs.get(tuple(w[k : k + 24]), ())}
    assert want <= got
