"""Problem 1: one consistent form for text that looks the same.

A token is brought to its form in three steps.  Compatibility normalisation: the
letters are decomposed; full-width and half-width forms, ligatures and unusual
blanks become plain, while raised, circled, fraction and trade-mark signs, which
look different, stay.  Ignorable characters are deleted.  Then every letter that
has look-alikes in other scripts opens a column of a lattice, one node for each
script, and Viterbi takes the best path under character trigram scores of the
scripts, learnt from the corpus, with a penalty for leaving a script.  Letters
that look nearly alike open a column too, with a price for the other reading: so
the path decides whether a stray one is a slip of script or the letter of a word
of its own, and two texts are equal when their best paths are.  What
differs in case, accents, punctuation or by a misreading stays different.

Defined results: null stays null; a text of ignorable characters and blanks only
becomes empty; blanks around a text go, blanks within become one space.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters that look alike, by script (fixed values): Latin, Cyrillic, Greek, "." for none.
ALIKE = (
    "aа. eе. oоο pр. cс. yу. xх. iі. jј. sѕ. hһ. dԁ. qԛ. wԝ. v.ν "
    "AАΑ BВΒ EЕΕ KКΚ MМΜ HНΗ OОΟ PРΡ CС. TТΤ XХΧ IІΙ JЈ. SЅ. YҮΥ Z.Ζ N.Ν WԜ. QԚ. .ГΓ .ПΠ .ФΦ "
).split()
#: Letters of other scripts that look nearly like a Latin one (fixed values): the lattice decides by their word.
NEARLY = {"к": "k", "м": "m", "т": "t", "κ": "k", "τ": "t"}
SCRIPTS = "LCG"
#: Look-alike -> its class, named by the first of its letters.
CLASS = {c: next(x for x in row if x != ".") for row in ALIKE for c in row if c != "."}
MEMBERS = {next(x for x in row if x != "."): row for row in ALIKE}
#: For str.translate: every look-alike to one letter, and hyphens to one.
LATIN = {ord(c): k for c, k in CLASS.items()} | {0x2010: "-", 0x2011: "-", 0xB5: "\u03bc"}
#: Runs of letters of one script.
PURE = re.compile("[A-Za-z\u00c0-\u024f\u0300-\u036f]+|[\u0400-\u052f\u0300-\u036f]+|[\u0370-\u03ff\u0300-\u036f]+")
IGNORABLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10)}
#: Cost, in nats, of a neighbour in another script, and of reading a letter as one that looks nearly alike.
SWITCH, NEAR_COST = 6.0, 3.0


def plain(c: str) -> str:
    """Compatibility form of a character, where it looks the same."""
    kind = unicodedata.decomposition(c)
    if not kind.startswith("<"):
        return c
    tag, *codes = kind.split()
    letter = unicodedata.category(c)[0] == "L" and len(codes) > 1
    if tag in ("<wide>", "<narrow>") or (tag == "<compat>" and letter):
        return "".join(chr(int(x, 16)) for x in codes)
    return c


def visible(text: str) -> str:
    """Decomposed plain characters, each look-alike by its class."""
    if text.isascii():
        return " ".join(text.split())
    out = []
    for c in unicodedata.normalize("NFD", text):
        code = ord(c)
        if code < 128:
            out.append(c)
        elif c.isspace():
            out.append(" ")
        elif unicodedata.category(c) != "Cf" and code not in IGNORABLE:
            out.append(plain(c))
    text = unicodedata.normalize("NFD", "".join(out)).translate(LATIN)
    return " ".join(text.split())


class Scripts:
    """Character trigram scores within each script, from counts of runs of one, two and three characters."""

    def __init__(self, counts: Iterable[tuple[str, int]]):
        self.count: Counter[str] = Counter()
        for gram, n in counts:
            self.count[gram] += n
        self.memo: dict[str, str] = {}
        self.size = sum(n for g, n in self.count.items() if len(g) == 1)

    def score(self, before: str, c: str) -> float:
        """Log probability of a character after the two before it, backing off to one and to none."""
        p = (self.count[c] + 0.1) / (self.size + 100)
        for k in (1, 2):
            if len(before) >= k:
                p = (self.count[before[-k:] + c] + 10 * p) / (self.count[before[-k:]] + 10)
        return math.log(p)

    def form(self, text: str | None) -> str | None:
        if text is None:
            return None
        seen = visible(text)
        if len(self.memo) > 500_000:
            self.memo.clear()
        if (done := self.memo.get(seen)) is None:
            done = self.memo[seen] = unicodedata.normalize("NFC", " ".join(map(self._best, seen.split(" "))))
        return done

    def _best(self, token: str) -> str:
        """Viterbi over the readings of the letters; ties go to the earlier script.

        A state is the last two letters as read.  Letters of no script are
        passed over, so they neither part a word nor cost anything.
        """
        paths = {"^": (0.0, "", "")}  # the last two letters -> score, text, script of the last
        for c in token:
            nodes = readings(c)
            if nodes is None:
                paths = {k: (score, text + c, script) for k, (score, text, script) in paths.items()}
                continue
            fresh: dict[str, tuple[float, str, str]] = {}
            for script, x, price in nodes:
                for before, (score, text, last) in paths.items():
                    total = score - price - SWITCH * (last not in ("", script)) + self.score(before if last in ("", script) else "", x)
                    key = (before + x)[-2:]
                    if key not in fresh or total > fresh[key][0] + 1e-12:
                        fresh[key] = total, text + x, script
            paths = fresh
        return max(paths.values(), key=lambda p: p[0])[1]


@functools.cache
def readings(c: str) -> list[tuple[str, str, float]] | None:
    """Script, letter and price of what a character can be read as; None if it belongs to no script."""
    if (row := MEMBERS.get(c)) is not None:
        return [(SCRIPTS[i], x, 0.0) for i, x in enumerate(row) if x != "."]
    if not (own := script_of(c)):
        return None
    near = NEARLY.get(c)
    return [(own, c, 0.0)] + ([("L", near, NEAR_COST)] if near else [])


def script_of(c: str) -> str:
    """L, C, G, or '' for what belongs to no script."""
    if c.isascii():
        return "L" if c.isalpha() else ""
    name = unicodedata.name(c, "")
    return next((s for s, n in zip(SCRIPTS, ("LATIN", "CYRILLIC", "GREEK")) if name.startswith(n)), "")


def learn_scripts(texts: DataFrame, column: str) -> Scripts:
    """Counts of runs of up to three characters, all of one script, over all tokens.

    The result has at most one row for three letters of an alphabet, some ten
    thousands, whatever the corpus.
    """
    tokens = texts.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return Scripts((r.gram, r.n) for r in _grams(tokens, column).collect())


def _grams(tokens: DataFrame, column: str) -> DataFrame:
    """``gram, n`` of distinct tokens with their counts; every task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for b in batches:
            for text, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for part in PURE.findall(unicodedata.normalize("NFD", text)):
                    whole = "^" + part
                    for k in (1, 2, 3):
                        for i in range(len(whole) - k + 1):
                            total[whole[i : i + k]] += n
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.string()), pa.array(total.values(), pa.int64())], ["gram", "n"])

    return tokens.select(column, "n").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def consistent(df: DataFrame, columns: dict[str, str], scripts: Scripts) -> DataFrame:
    """Adds, for each column, its consistent form under the name given."""
    shared = df.sparkSession.sparkContext.broadcast(scripts)
    schema = df.select("*", *(F.lit(None).cast("string").alias(n) for n in columns.values())).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = shared.value.form
        for b in batches:
            made = [pa.array(map(form, b.column(b.schema.get_field_index(c)).to_pylist()), pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, *columns.values()])

    return df.mapInArrow(run, schema)


def same_looking_labels(words: DataFrame, labels: DataFrame) -> DataFrame:
    """``word_id, label_id`` where the label and its word's value look the same and differ in code points."""
    scripts = learn_scripts(words, "value")
    typed = labels.select("label_id", F.col("word_id").alias("_word"), F.col("text").alias("_text")).filter("_text is not null and label_id is not null").distinct()
    read = words.select("word_id", "value").filter("value is not null and value != '' and word_id is not null")
    pairs = read.join(typed, read.word_id == typed["_word"]).filter("value != _text").drop("_word")
    return consistent(pairs, {"value": "value_form", "_text": "text_form"}, scripts).filter("value_form = text_form").select("word_id", "label_id").distinct()
