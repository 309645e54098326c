"""Language and quality of pages: planted pages, nulls, repeats, empty tables."""

import random
from datetime import datetime

import numpy as np
import pytest

from pyspark.sql import functions as F

from paperloom.llm.language import LANGUAGES, SWITCH, detect_languages, language_cases, language_spans, viterbi
from paperloom.llm.quality import page_statistics

T = datetime(2024, 1, 1)
WORDS = "word_id long, page_id long, block_idx int, line_idx int, word_idx int, value string, geometry array<double>, objectness_score double, confidence double, label int, received_at timestamp"
PAGES = "page_id long, language struct<value:string,confidence:double>, received_at timestamp, lang string"
SENTENCES = {
    "en": "the old record was copied from the second page and it does not mention this letter".split(),
    "de": "das alte Buch wurde von der zweiten Seite kopiert und es nennt nicht diesen Brief".split(),
    "fr": "le vieux dossier a été copié de la deuxième page et il ne cite pas cette lettre".split(),
    "ru": "старый журнал был взят со второй страницы и он не называет этого письма".split(),
}


class Pages:
    def __init__(self):
        self.words, self.pages, self.id = [], [], 0

    def lines(self, page, block, lines, wide=False):
        for i, line in enumerate(lines):
            x = 0.1
            for k, v in enumerate(line):
                self.id += 1
                end = x + 0.01 * len(v or "x")
                self.words.append((self.id, page, block, i, k, v, [x, 0.1, end, 0.12], 0.9, 0.8, 1, T))
                x = end + (0.1 if wide else 0.01)

    def prose(self, page, block, lang, n=6):
        self.lines(page, block, [random.sample(SENTENCES[lang], 9)[:-1] + ["end."] for _ in range(n)])

    def page(self, page, label):
        self.pages.append((page, None if label == 0 else (label, 0.5), T, "clash"))


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(2)
    p = Pages()
    for i in range(60):
        lang = list(SENTENCES)[i % 4]
        p.prose(i, 0, lang)
        p.prose(i, 1, lang)
        p.page(i, lang)
    p.prose(100, 0, "de"), p.prose(100, 1, "de"), p.prose(100, 2, "fr", 2), p.page(100, "German")
    p.prose(101, 0, "fr"), p.page(101, "en"), p.prose(102, 0, "ru"), p.page(102, 0), p.prose(103, 0, "en"), p.page(103, "en-GB")
    p.lines(104, 0, [[c * 4 for c in "|_=#"] for _ in range(6)]), p.page(104, "unknown")
    p.lines(105, 0, [["the", "record", "12", "34.5", "7"] for _ in range(6)], wide=True), p.page(105, "en")
    p.lines(106, 0, [["•", "the", "old", "record", "3"] for _ in range(6)]), p.page(106, "en")
    p.lines(107, 0, [["the", "old", "record"], ["the", "second", "page"], ["this", "letter"], ["the", "page"]]), p.page(107, "en")
    p.lines(108, 0, [[None, "", "the"]]), p.page(108, None)
    w = spark.createDataFrame(p.words + p.words[::7] + [(None, 1, 1, 1, 1, "x", None, None, None, None, T), (9999, None, 1, 1, 1, "x", None, None, None, None, T)], WORDS)
    return w, spark.createDataFrame(p.pages + p.pages[:3], PAGES)


def test_kinds(corpus):
    rows = {r.page_id: r for r in page_statistics(corpus[0]).collect()}
    assert {k: rows[k].kind for k in (0, 1, 2, 3, 100, 104, 105, 106, 107)} == {**dict.fromkeys((0, 1, 2, 3, 100), "prose"), 104: "junk", 105: "table", 106: "list", 107: "list"}
    assert rows[0].n_words == 108 and rows[0].n_lines == 12 and rows[0].stop_line_share == 1.0
    assert abs(rows[0].mean_confidence - 0.8) < 1e-6 and rows[108].n_words == 3
    assert page_statistics(corpus[0].limit(0)).collect() == []


def test_languages(corpus):
    got = {(r.page_id, r.block_idx, r.lang) for r in language_cases(*corpus).collect()}
    assert got == {(100, 2, "fr"), (101, -1, "fr"), (102, -1, "ru")}
    pages = {r.page_id: r for r in detect_languages(*corpus)[0].collect()}
    assert pages[0].lang == "en" and pages[0].confidence > 0.9 and (pages[108].lang, pages[108].confidence) == (None, 0.0)
    assert language_cases(corpus[0].limit(0), corpus[1]).collect() == [] and language_cases(corpus[0], corpus[1].limit(0)).collect() == []


def test_viterbi_against_plain():
    rng = np.random.default_rng(1)
    score = rng.normal(0, 6, (200, len(LANGUAGES)))
    start = np.array([0, 1, 2, 40, 41, 120])
    got = viterbi(score, start)
    for a, b in zip(start, [*start[1:], 200]):
        best, path = score[a], [[i] for i in range(9)]
        for t in range(a + 1, b):
            step = [[best[j] - SWITCH * (i != j) for j in range(9)] for i in range(9)]
            path = [path[int(np.argmax(step[i]))] + [i] for i in range(9)]
            best = np.array([max(step[i]) for i in range(9)]) + score[t]
        mine = sum(score[t, got[t]] for t in range(a, b)) - SWITCH * (np.diff(got[a:b]) != 0).sum()
        assert abs(mine - best.max()) < 1e-6


def test_a_page_of_one_line(spark):
    """A line of many words is cut, and its parts count as one line: as a plain count over all of it."""
    random.seed(5)
    n, rows, x = 3000, [], 0.0
    for k in range(n):
        gap = 0.05 if k % 10 == 0 else 0.001
        x += gap
        place = None if k % 97 == 5 else [x, 0.1, x + 0.01, 0.12]
        rows.append((k, 7, 0, 0, k, random.choice(["alpha", "beta.", "•", "Gamma"]) if k != 1023 else "end.", place, 0.5, 0.5, 1, T))
        x += 0.01
    r = page_statistics(spark.createDataFrame(rows, WORDS), {"alpha", "beta"}).first()
    has = [(a[6], b[6]) for a, b in zip(rows, rows[1:]) if a[6] and b[6]]
    assert (r.n_words, r.n_lines) == (n, 1) and r.stop_line_share == float(rows[-1][5].endswith(".")) and r.bullet_line_share == float(rows[0][5] == "•")
    assert abs(r.wide_gap_share - sum(b[0] - a[2] > 0.02 for a, b in has) / len(has)) < 1e-9


def test_spans(corpus, spark):
    """A switch inside a block gives two spans; a feed with one wrong label for all its pages does not teach it."""
    w, p = corpus
    mixed = SENTENCES["en"] + SENTENCES["de"]
    line = [(200_000 + k, 300, 0, k // 8, k % 8, v, None, 0.5, 0.5, 1, T) for k, v in enumerate(mixed)]
    got = language_spans(w.union(spark.createDataFrame(line, WORDS)), p).filter("page_id = 300").orderBy("span_idx").collect()
    assert [(r.lang, r.first_word_id, r.last_word_id, r.n_words) for r in got] == [("en", 200_000, 200_000 + 15, 16), ("de", 200_000 + 16, 200_000 + 30, 15)]
    assert all(r.confidence > 0.7 for r in got)
    wrong = p.withColumn("language", F.when(F.expr("page_id < 60 and page_id % 12 = 1"), F.struct(F.lit("en").alias("value"), F.lit(0.5).alias("confidence"))).otherwise(F.col("language")))
    cases = {(r.page_id, r.block_idx, r.lang) for r in language_cases(w, wrong).collect()}
    assert {(k, -1, "de") for k in range(1, 60, 12)} <= cases
