"""Planted noise on pages: pieces, misreadings, furniture; and the text without it."""

import random
from datetime import datetime

from paperloom.llm.scannoise import GLYPHS, Model, core, divided, form_of, page_number_part, paragraphs, scan_noise, skip_gram_vectors, undone

T = datetime(2024, 1, 1)
WORDS = "word_id long, page_id long, block_idx int, line_idx int, word_idx int, value string, geometry array<double>, confidence double, scan_id string"
PAGES = "page_id long, scan_id long, page_idx int, layout array<struct<type:string,geometry:array<double>,confidence:double>>, received_at timestamp"
VOCABULARY = "the old record was copied from second page and does not mention this letter under number before month".split()


def build():
    random.seed(6)
    misreadings = sorted({w[:k] + bad + w[k + len(good) :] for w in VOCABULARY if len(w) > 4 for good, bad in GLYPHS[:20] for k in [w.find(good)] if k >= 0} - set(VOCABULARY))
    random.shuffle(misreadings)
    words, pages, want = [], [], set()

    def block(page, b, lines, y):
        for i, line in enumerate(lines):
            for k, v in enumerate(line):
                kind = None
                if isinstance(v, tuple):
                    v, kind = v
                words.append((len(words) + 1, page, b, i, k, v, [0.1 + k * 0.05, y + i * 0.02, 0.14 + k * 0.05, y + i * 0.02 + 0.014], 0.9, "x"))
                if kind:
                    want.add((len(words), kind))

    for p in range(min(40, len(misreadings))):
        scan, idx = divmod(p, 4)
        pages.append((p, scan, idx, None, T))
        h = "header"
        if idx:
            block(p, 0, [[("Kolo", h), ("–", h), ("the", h), ("record", h)]], 0.05)
        else:
            block(p, 0, [["The", "old", "record"]], 0.05)
        body = [[random.choice(VOCABULARY) for _ in range(9)] for _ in range(12)]
        body[3][4] = (misreadings[p], "misread")
        body[5][-1], body[6][0] = ("men-", "hyphen"), "tion"
        body[8][-1], body[9][0] = "Kolo-", "Maro"
        body[10][2] = None
        block(p, 1, body, 0.1)
        n = "page_number"
        block(p, 2, [[("Page", n), (str(idx + 1), n)]] if idx % 2 else [[("Firm", h), ("·", h), ("No.", h), ("A33711", h)]], 0.93)
    pages.append((900, 50, 1, None, T))
    block(900, 0, [["xkcd", "q-", "zz1"] for _ in range(5)], 0.05)
    return words, pages, want


def test_planted(spark):
    words, pages, want = build()
    w, p = spark.createDataFrame(words + words[::5], WORDS), spark.createDataFrame(pages + pages[:2], PAGES)
    got = [(r.word_id, r.kind) for r in scan_noise(w, p).collect()]
    assert len(got) == len(set(got))
    assert want - set(got) == set() and set(got) - want == set()
    text = {(r.page_id, r.block_idx): r.text for r in paragraphs(w, p).collect()}
    assert " mention " in text[1, 1] and "Kolo- Maro" in text[1, 1] and (1, 0) not in text and "rnonth" not in text[1, 1]
    assert scan_noise(w.limit(0), p).collect() == [] and scan_noise(w.limit(0), p.limit(0)).collect() == []
    assert len(scan_noise(w, p.limit(0)).collect()) > 0


def test_rules():
    assert page_number_part("Page 8 Kos Val".split()) == [True, True, False, False]
    assert page_number_part("Kos Val – 3 –".split()) == [False, False, True, True, True]
    assert page_number_part("1 | 4".split()) == [True] * 3 and page_number_part(["[3]"]) == [True] and page_number_part(["ii"]) == [True]
    assert not any(page_number_part("Firm · Nr. A33711".split())) and not any(page_number_part(["1.", "the"]))
    m = Model({"month": 90, "follow": 9, "up": 9, "follow-up": 5, "mention": 50, "9999-99-99": 40, "tr999999": 30})
    assert "month" in set(undone("rnonth")) and m.corrections("rnonth") == ("month",)
    assert m.corrections("202S-03-14") == ("2025-03-14",) and "TR102345" in m.corrections("TR1O2345") and m.known("2025-03-14") and "Loelwa" in m.corrections("L0elwa")
    assert form_of("«N0te,") == "n0te" and form_of("(2025-03-14)") == "9999-99-99" and core("verä-") == "vera\u0308"
    assert divided(m, "men-", "tion,") == (True, None) and divided(m, "follow-", "up") == (False, None) and divided(m, "(2025-", "03-14)")[0] is False
    assert divided(m, "Ko~", "lo")[0] and divided(m, "Ko-", "Lo")[0] is False and divided(m, "rnon-", "th") == (True, 0)
    assert core("  «Ｗоrd», ") == "Word"


def test_vectors_and_context():
    """Vectors give back the mutual information of the pairs, and the context decides between two corrections."""
    import numpy as np

    from paperloom.llm.scannoise import corrected

    count = {f: 50 for f in ("boat", "goat", "sails", "eats", "sea", "grass")}
    m = Model(count)
    heard = [("boat", "sails"), ("boat", "sea"), ("goat", "eats"), ("goat", "grass")]
    a, b, n = zip(*sorted((m.code[x], m.code[y], 20) for p in heard for x, y in (p, p[::-1])))
    m.word, m.context = skip_gram_vectors(np.array(a), np.array(b), np.array(n), len(m.code))
    assert abs(float(m.word[m.code["boat"]] @ m.context[m.code["sea"]]) - np.log(4)) < 0.01
    near = lambda *ws: np.array([m.code[w] for w in ws])
    m.memo["qoat"] = ("goat", "boat")
    assert corrected(m, "qoat", near("sails", "sea")) == "boat" and corrected(m, "qoat", near("eats")) == "goat"


def test_paragraphs_exactly(spark):
    """The text of every block, word for word."""
    words, pages, want = build()
    w, p = spark.createDataFrame(words, WORDS), spark.createDataFrame(pages, PAGES)
    kinds = dict(want)
    expected = {}
    right = {bad: w_ for w_ in VOCABULARY for good, bad_ in GLYPHS for k in range(len(w_)) if w_.startswith(good, k) for bad in [w_[:k] + bad_ + w_[k + len(good) :]]}
    for i, (_, page, b, line, k, v, *_rest) in enumerate(words, 1):
        kind = kinds.get(i)
        if v is None or kind in ("header", "page_number"):
            continue
        v = v[:-1] if kind == "hyphen" else right[v] + " " if kind == "misread" else v + " "
        expected[page, b] = expected.get((page, b), "") + v
    got = {(r.page_id, r.block_idx): r.text for r in paragraphs(w, p).collect()}
    assert [(g, e) for k, t in expected.items() for g, e in zip(got.get(k, "").split(" "), t.rstrip().split(" ")) if g != e] == []
    assert got == {k: v.rstrip() for k, v in expected.items()}
