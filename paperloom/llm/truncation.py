"""Problem 8: texts that their source cut short.

Evidence, each gathered over the whole corpus:

* length: the texts of a source pile up at a length, its longest or one that
  stands out of its neighbours, in characters or in bytes; or the source reports more characters (or bytes, whichever it
  reports elsewhere) than the text has;
* vocabulary trie: the final token is hardly ever a word of its own, but a
  proper prefix of other words.  The trie is a table of its nodes, the
  prefixes, with the number of words that end at a node and that go on from it;
* unfinished unit: the text ends without a sentence mark, and what follows the
  last mark is nothing that stands alone elsewhere (a title, a list entry, the
  label of a row, a closing), compared without names and numbers, and its last
  word is not one that mostly ends sentences.

A text found cut counts wherever the same text is repeated.

Defined results: null, empty and blank texts are never cut; a null source is a
source of its own; a null reported length is no evidence.  Repeated ids give one
row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

#: Invisible characters, which are no part of any comparison, and what a cut may leave behind.
INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
LEFT = " \t\n\r\f\v\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u3000\u2026\ufffd\\"
TERMINATED = re.compile("""[.!?;:\u3002\uff0e\uff01\uff1f)\\]\u00bb\u201d"]$|[.!?]['\u2019]$|[\u00b9\u00b2\u00b3\u207e\u207d]$""")
_BULLET = "^\\s*(?:[-\u2013\u2014*\u2022\u25aa\u2610\u00b7\u25e6]|\\(?WORD{1,3}[.)])\\s"
BULLET = re.compile(_BULLET.replace("WORD", "\\w") + "+")
SEPARATOR = re.compile("\\t|\\s\\s+|;|\\||:(?:\\s|$)")
#: An entry of a list or a row, for Python and for Arrow.
STRUCTURED = re.compile(BULLET.pattern + "|" + SEPARATOR.pattern)
STRUCTURED_ARROW = _BULLET.replace("WORD", "[\\pL\\pN_]") + "|\\t|\\s\\s|;|\\||:(?:\\s|$)"
DIGIT = "\\d\u00b2\u00b3\u00b9\u00bc-\u00be\u2070-\u2089\u2150-\u218f\u2460-\u24ff"
NUMBER = re.compile(f"(?:\\S{{1,3}}\\s+)?\\S*[{DIGIT}]\\S*")
LETTERS = "[^\\W\\d_]|[\u0300-\u036f]"
PIECE = re.compile(f"(?:{LETTERS})+")
LAST = re.compile(f"((?:{LETTERS})+)$")
PART = re.compile("[\\w\u0300-\u036f/-]+")
DROPPED = re.compile(f"[{DIGIT}_]|^(.)\\1+$")
PARAGRAPH, SENTENCE, MARK = re.compile("\\n[ \\t\u00a0]*\\n"), re.compile("(?<=[.!?])\\s+"), re.compile("[!?]|\\.\\s+[^\\W\\d_]+[\\s,]")
#: Distinct keys a task counts before it passes its counts on.
MOST_KEYS = 300_000
SCHEMA = "part string, doc_id {doc}, source string, n_chars long, chars long, bytes long, fingerprint long, broken boolean, prose boolean, ended boolean, last string, letters double, words array<string>, skeleton string, n long, ends long"


def entry(line: str) -> str:
    """Of a list entry all, of a row or form its label."""
    return line if BULLET.match(line) else SEPARATOR.split(line, maxsplit=1)[0]


def skeleton_words(unit: str) -> list[str]:
    """Words of a unit in lower case, without bullet, numbers and their signs, and names."""
    parts = PART.findall(NUMBER.sub(" ", BULLET.sub("", unit, count=1)))
    return [w.lower() for i, w in enumerate(parts) if not DROPPED.search(w) and (i == 0 or not w[0].isupper())]


def end_of(text: str) -> tuple[bool, bool, bool, str, float, list[str]]:
    """``broken, prose, ended, last, letters, words`` of a text's end."""
    broken = text.endswith("\ufffd")
    text = text.rstrip(LEFT)
    paragraph = PARAGRAPH.split(text)[-1]
    line = paragraph.rsplit("\n", 1)[-1]
    structured = bool(STRUCTURED.search(line))
    first = next((c for c in paragraph if c.isalpha()), "")
    plain_list = "\n" in paragraph and first.islower() and not MARK.search(paragraph)
    unit = entry(line) if structured else line if plain_list else SENTENCE.split(paragraph)[-1]
    ended = bool(TERMINATED.search(text[-3:])) or (structured and not line[-1:].isalpha())
    last = LAST.search(line)
    dense = "".join(unit.split())
    letters = sum(map(str.isalpha, dense)) / max(1, len(dense))
    return broken, not structured and not plain_list, ended, last[1] if last else "", letters, skeleton_words(unit)


def _counts(texts: pa.Array, words: dict[str, list[int]], units: Counter[str]) -> None:
    """Adds the words of the texts but their last, and the entries of their lines but the last."""
    tokens = pc.utf8_split_whitespace(pc.utf8_lower(texts)).flatten().value_counts()
    for token, n in zip(tokens.field(0).to_pylist(), tokens.field(1).to_pylist()):
        stop = token[-1:] in (".", "!", "?")
        for w in [token[:-1] if stop else token] if token[:-1].isalpha() and (stop or token.isalpha()) else PIECE.findall(token):
            if (c := words.get(w)) is None:
                words[w] = c = [0, 0]
            c[0] += n
        if stop and token[:-1]:
            if (c := words.get(w) if (found := PIECE.findall(token)) and token[:-1].endswith(w := found[-1]) else None) is not None:
                c[1] += n
    lines = pc.split_pattern(texts, "\n")
    ends = lines.offsets.to_numpy()
    flat = pc.utf8_rtrim_whitespace(lines.flatten())
    keep = np.ones(len(flat), bool)
    keep[ends[1:][ends[1:] > ends[:-1]] - 1 - ends[0]] = False
    flat = flat.filter(pa.array(keep))
    flat = flat.filter(pc.and_not(pc.match_substring_regex(flat, STRUCTURED_ARROW), pc.match_substring_regex(flat, "[.!?]$|^$"))).value_counts()
    for line, n in zip(flat.field(0).to_pylist(), flat.field(1).to_pylist()):
        if key := " ".join(skeleton_words(entry(line))):
            units[key] += n


def _parts(documents: DataFrame) -> DataFrame:
    """One pass over the texts: a row for the end of each, and counts of words and of entries by task."""
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    schema = SCHEMA.format(doc=doc_type)

    def rows(part: str, fields: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part] * n) if f.name == "part" else fields[f.name].cast(f.type) if f.name in fields else pa.nulls(n, f.type) for f in target], schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(documents.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, list[int]] = {}
        units: Counter[str] = Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            yield rows("word", {"last": pa.array(words, pa.string()), "n": pa.array([c[0] for c in words.values()], pa.int64()), "ends": pa.array([c[1] for c in words.values()], pa.int64())}, len(words))
            yield rows("unit", {"skeleton": pa.array(units, pa.string()), "n": pa.array(units.values(), pa.int64())}, len(units))
            words.clear()
            units.clear()

        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            texts = pc.replace_substring(pc.replace_substring(texts, "\r\n", "\n"), "\r", "\n")
            texts = pc.replace_substring_regex(texts, "[\u00ad\u200b-\u200f\u2060\ufeff]", "")
            ends = [end_of(t) for t in texts.to_pylist()]
            _counts(texts, words, units)
            for e in ends:
                if e[3] and (c := words.get(e[3].lower())):
                    c[0] -= 1
            made = dict(zip(("broken", "prose", "ended", "last", "letters", "words"), (pa.array(x) for x in zip(*ends)))) if ends else {}
            if ends:
                made["words"] = pa.array([e[5] for e in ends], pa.list_(pa.string()))
                made["skeleton"] = pa.array([" ".join(e[5]) for e in ends])
                yield rows("end", {c: b.column(b.schema.get_field_index(c)) for c in ("doc_id", "source", "n_chars", "chars", "bytes", "fingerprint")} | made, b.num_rows)
            if len(words) + len(units) > MOST_KEYS:
                yield from counted()
        yield from counted()

    text = F.col("text").cast("string")
    kept = documents.filter(text.rlike(r"\S")).select("doc_id", F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"), F.length(text).cast("long").alias("chars"), F.octet_length(text).cast("long").alias("bytes"), F.xxhash64(text).alias("fingerprint"), text.alias("text"))
    return kept.mapInArrow(run, schema)


def _sources(ends: DataFrame, spike: int) -> DataFrame:
    """Of each source: its limits, if it has any, and what it reports as length."""
    lengths = ends.select("source", F.posexplode(F.array("chars", "bytes")).alias("measure", "size"), "fingerprint", "ended")
    sizes = lengths.distinct().groupBy("source", "measure", "size").agg(F.count(F.lit(1)).alias("n"), F.sum((~F.col("ended")).cast("long")).alias("open"))
    whole = Window.partitionBy("source", "measure")
    span = lambda c, low, high: F.coalesce(F.sum(c).over(whole.orderBy("size").rangeBetween(low, high)), F.lit(0))
    sizes = sizes.select(
        "source", "measure", "size", "n", span("n", -5, 0).alias("at"), span("open", -5, 0).alias("at_open"), span("n", -205, -6).alias("below"), span("n", 1, 200).alias("above"),
        F.max("size").over(whole).alias("most"), F.count(F.lit(1)).over(whole).alias("tried"),
    )
    at, below, expected = F.col("at"), F.col("below") * 6 / 200, F.greatest(F.lit(1), "below", "above") * 6 / 200
    # Of many lengths tried some have a few texts by chance: a bound on the tail of the Poisson distribution tells.
    chance = at * F.log(at / expected) - at + expected > F.log(F.col("tried") * 1000)
    inside = (at > 5 * expected) & chance & (4 * F.col("n") >= at) & (2 * F.col("at_open") > at)
    limits = (
        sizes.filter((at >= spike) & (((F.col("size") == F.col("most")) & (at > 5 * below)) | inside))
        .groupBy(F.col("source").alias("_limited")).agg(F.collect_list(F.when(F.col("measure") == 0, F.col("size"))).alias("char_limits"), F.collect_list(F.when(F.col("measure") == 1, F.col("size"))).alias("byte_limits"))
    )
    equal = lambda c: F.avg((F.col("n_chars") == F.col(c)).cast("int"))
    reports = ends.groupBy(F.col("source").alias("_source")).agg(equal("chars").alias("as_chars"), equal("bytes").alias("as_bytes"))
    return reports.join(limits, reports["_source"].eqNullSafe(limits["_limited"]), "left").drop("_limited")


def truncation_evidence(documents: DataFrame, spike: int = 4, rare: float = 0.02, known_share: float = 0.001, name_share: float = 0.005, least: int = 5) -> DataFrame:
    """``doc_id, source, fingerprint, by_limit, by_report, by_prefix, by_unit`` of every text that is not blank.

    ``spike``: texts at the limit, at least, and five times what the lengths
    below it let expect.  ``rare``: share of a prefix's occurrences up to which
    it is no word.  ``known_share``: occurrences, per text, from which a word is
    known; ``name_share``: the same for what a capitalised prefix must lead to,
    as there are many more names than nouns.
    """
    parts = checkpoint(_parts(documents))  # small against the texts, and read several times
    ends = parts.filter("part = 'end'").drop("part", "n", "ends")
    total = ends.count()
    at_least = lambda share: max(3, share * total)

    ends = ends.join(_sources(ends, spike), ends.source.eqNullSafe(F.col("_source")), "left").drop("_source")
    over = lambda size, limits: F.coalesce(F.exists(limits, lambda limit: (F.col(size) <= limit) & ((F.col(size) >= limit - 1) | ((F.col(size) >= limit - 5) & ~F.col("ended")))), F.lit(False))
    true_size = F.when(F.col("as_chars") >= F.col("as_bytes"), F.col("chars")).otherwise(F.col("bytes"))
    ends = ends.withColumn("by_limit", over("chars", "char_limits") | over("bytes", "byte_limits")).withColumn("by_report", F.coalesce(F.col("n_chars") > true_size, F.lit(False)))
    ends = checkpoint(ends.drop("n_chars", "chars", "bytes", "as_chars", "as_bytes", "char_limits", "byte_limits", "part"))

    open_ = ends.filter(~F.col("ended") & ~F.col("by_limit") & ~F.col("by_report"))
    asked = open_.filter((F.col("skeleton") != "") & (F.col("letters") >= 0.6))

    # Words of the corpus but for the final tokens; the trie's nodes below the final tokens.
    words = parts.filter("part = 'word'").groupBy(F.col("last").alias("word")).agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))
    words = checkpoint(words.filter("n > 0"))
    finals = ends.filter(~F.col("ended") & (F.col("last") != "")).select(F.lower("last").alias("node")).distinct()
    prefixes = words.filter("length(word) > 1").select("n", F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> left(word, i))")).alias("node"))
    trie = prefixes.groupBy("node").agg(F.sum("n").alias("beyond"))
    nodes = finals.join(trie, "node").join(words.withColumnRenamed("word", "node"), "node", "left").select(F.col("node").alias("_node"), "beyond", F.coalesce(F.when(F.col("n") >= 3, F.col("n")), F.lit(0)).alias("own"))
    # Only texts without an end are asked; those without a final word or a unit meet nothing, each on a key of its own.
    spread = lambda key: F.when(key != "", key).otherwise(F.concat(F.lit("\0"), F.col("fingerprint")))
    done = ends.filter("ended")
    ends = ends.filter("not ended").withColumns({"_key": spread(F.lower("last")), "_unit": spread(F.col("skeleton"))})
    ends = ends.join(nodes, F.col("_key") == F.col("_node"), "left").drop("_node")
    ends = ends.join(words.select(F.col("word").alias("_word"), ((F.col("ends") + 0.5) / (F.col("n") + 10)).alias("stops")), F.col("_key") == F.col("_word"), "left").drop("_word")

    # Units that stand alone: entries and labels inside texts, and frequent ends of whole texts.
    alone = parts.filter("part = 'unit'").groupBy("skeleton").agg(F.sum("n").alias("n")).filter("n >= 2")
    closings = open_.groupBy("skeleton").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= at_least(0.0005))
    alone = alone.union(closings).select(F.col("skeleton").alias("_alone")).distinct()
    ends = ends.join(alone, F.col("_unit") == F.col("_alone"), "left")

    # Are the words of the unit words at all?
    known = asked.select(F.col("fingerprint").alias("_text"), "words").distinct().select("_text", F.explode("words").alias("word")).join(words, "word", "left").groupBy("_text").agg(F.avg((F.coalesce("n", F.lit(0)) >= at_least(known_share)).cast("int")).alias("known"), F.count(F.lit(1)).alias("long"))
    ends = ends.join(known, ends.fingerprint == F.col("_text"), "left").drop("_text")
    # A name after a closing is an ending of its own: there a prefix of a few other names tells nothing.
    signed = F.col("last").rlike(r"^\p{Lu}") & F.col("_alone").isNotNull()
    prefix = (F.col("own") < rare * F.col("beyond")) & (F.col("beyond") >= F.when(signed, max(least, name_share * total)).otherwise(least))
    readable = (F.col("known") >= 0.6) | ((F.col("known") >= 0.4) & (F.col("long") <= 3))
    kept = ["doc_id", "source", "fingerprint", "by_limit", "by_report"]
    told = ends.select(
        *kept,
        F.coalesce(prefix & readable, F.lit(False)).alias("by_prefix"),
        F.coalesce(F.col("broken") | (F.col("prose") & F.col("_alone").isNull() & (F.col("known") >= 0.6) & (F.coalesce("stops", F.lit(0)) < 0.5)), F.lit(False)).alias("by_unit"),
    )
    return told.union(done.select(*kept, F.lit(False).alias("by_prefix"), F.coalesce("broken", F.lit(False)).alias("by_unit"))).distinct()


def truncated(documents: DataFrame, **parameters: float) -> DataFrame:
    """Evidence of every text, and ``cut``: whether it or an equal text is cut."""
    rows = checkpoint(truncation_evidence(documents, **parameters))  # a few bytes a text, joined with itself
    any_ = F.col("by_limit") | F.col("by_report") | F.col("by_prefix") | F.col("by_unit")
    cut = rows.filter(any_).select(F.col("fingerprint").alias("_cut")).distinct()
    return rows.join(cut, rows.fingerprint == F.col("_cut"), "left").withColumn("cut", F.col("_cut").isNotNull()).drop("_cut")


def truncation_shares(documents: DataFrame, **parameters: float) -> DataFrame:
    """Of each source: its texts, those cut, and their share."""
    return truncated(documents, **parameters).groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.col("cut").cast("long")).alias("n_cut"), F.avg(F.col("cut").cast("double")).alias("cut_share"))
