"""Queries do the whole job: every word, every pair, whole widths."""

import pytest

from paperloom.functions import text as X
from paperloom.plans import documents as D

TEXT = "Straße ÉCOLE naïve книга Ελλάδα letter aabbcc abcdefghijkl ab x word Ångström été Zoë ДОМ слово λόγος bookkeeper a 12345678"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("whole"))
    rows = [(i, " ".join(TEXT.split()[i:] + TEXT.split()[:i]), "x", "s", 1) for i in range(8)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    return d


def test_ctc_decodes_every_word(spark, small):
    got = {(r.doc_id, r.word_idx): r.text for r in D.ctc_decode(spark, small).collect()}
    assert got == {(r.doc_id, r.word_idx): r.value for r in D.words(spark, small).collect()}
    assert "bookkeeper" in got.values() and "Ελλάδα" in got.values()


def test_padded_to_the_longest(spark, small):
    got = [list(r.codes) for r in D.encode_padded(spark, small).collect()]
    assert {len(c) for c in got} == {12 + 2} and all(c.count(62) == 1 and c[-1] == 63 for c in got)
    assert [*range(12), 62, 63] in got


def test_text_match_scores_all_pairs(spark, small):
    def folded(v):
        v = v.translate(str.maketrans(X.ACCENTED, X.PLAIN))
        for a, b in X.FOLD.items():
            v = v.replace(a, b)
        return v

    pairs = [(r.truth, r.predicted) for r in D.matched(spark, small).collect()]
    assert any(not t.isascii() for t, _ in pairs)
    levels = {"raw": lambda v: v, "caseless": str.lower, "folded": folded, "unicase": lambda v: folded(v).lower()}
    got = D.text_match(spark, small).first().asDict()
    assert got == {"n": len(pairs)} | {k: sum(f(t) == f(p) for t, p in pairs) / len(pairs) for k, f in levels.items()}
