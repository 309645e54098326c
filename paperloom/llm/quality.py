"""Problem 3: text quality statistics of pages.

A page is counted in chunks: some lines of a block, and of long lines a part.  A
chunk yields counts that add up and, for lines that may be cut, the state at its
ends: place and mark of the first and the last word.  A chunk takes every line
it sees for a whole one; where the parts of a line meet, the states of the
neighbours correct that: one line less, no line's start or end there, and the
gap between the two words.  Corrections are sums too, so chunks merge to blocks
and blocks to pages by Spark's partial and final aggregates, in a tree; ratios
and rules follow.

Blocks are told apart by rules on their ratios: a table has wide gaps between
the words of its lines; a list has lines that begin with a bullet or, without
capitals and sentence marks, with the same kind of small word; junk has hardly
any word that the corpus knows.  A page is of a kind when most of its words lie
in blocks that are not prose, or junk when hardly any of its words is known.

Defined results: a null value is an empty word, which counts as a word without
letters; null confidence and objectness are left out of their means; a page
without any word has no row; where a line of over 512 words lacks all words from
the 65th to the 512th, what follows is a line of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .lookalike import visible
from .pagestream import PART_WORDS, Lookup, chunk_words, edge, starts, word_tables

BULLET = re.compile(r"(?:[-–—*•▪☐☑✓·◦‣○●■□>]|\(?(?:\d{1,3}|[a-z]|[ivx]{1,4})[.)])$", re.I)
WORD = re.compile(r"[^\W\d_]{2}")
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Part of the page's width between two words of a line from which they are of two cells.
WIDE_GAP = 0.02
COUNTS = ["n_words", "n_chars", "n_letters", "n_digits", "n_symbols", "n_common", "n_wide", "n_gaps", "n_lines", "n_stops", "n_bullets", "n_small", "n_head_small", "n_confidence", "n_objectness"]
SUMS = ["sum_confidence", "sum_objectness"]
#: The state of a line's part: its place, and of its ends the places, marks and kinds.
STATE = "line_idx int, part int, x0 float, x1 float, stop boolean, bullet boolean, small boolean, head_small boolean"
#: Words from which a line's first part tells its state.
LONG = PART_WORDS // 8
STOPS = tuple(".!?;:…。．！？")


def bare(value: str) -> str:
    """A word's letters in lower case and consistent characters, '' if there are fewer than two different."""
    v = NOT_LETTERS.sub("", visible(value).lower())
    return v if len(set(v)) > 1 else ""


def common_words(words: DataFrame, share: float = 0.004) -> set[str]:
    """Words with at least ``share`` occurrences a page of their script, so that a rare script has its words too.

    Their number is at most the words of a mean page by ``share``: some ten
    thousand, whatever the corpus.  All words are counted.
    """
    w = words.filter("value is not null").select(F.lower(F.regexp_replace("value", r"[^\p{L}\p{M}]+", "")).alias("w")).filter("length(w) > 1")
    pages = words.agg(F.approx_count_distinct("page_id")).first()[0]
    script = F.when(F.col("w").rlike(r"\p{IsCyrillic}"), "C").when(F.col("w").rlike(r"\p{IsGreek}"), "G").otherwise("L").alias("script")
    counted = checkpoint(w.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("script", script))
    size = {r.script: r.n for r in counted.groupBy("script").agg(F.sum("n").alias("n")).collect()}
    least = F.coalesce(*(F.when(F.col("script") == k, F.lit(max(2, share * pages * n / sum(size.values())))) for k, n in size.items()), F.lit(2))
    return {b for r in counted.filter(F.col("n") >= least).select("w").collect() if (b := bare(r.w))}


def block_counts(words: DataFrame, common: set[str] | None = None) -> DataFrame:
    """``page_id, block_idx`` and the counts of a block."""
    known = words.sparkSession.sparkContext.broadcast(common_words(words) if common is None else common)
    g = F.col("geometry")
    rows = chunk_words(words, value=F.col("value"), x0=edge(g, 0, False), x1=edge(g, 0, True), confidence=F.col("confidence").cast("float"), objectness=F.col("objectness_score").cast("float"))

    def traits(values: list[str]) -> np.ndarray:
        out = np.zeros((len(values), 10), np.int32)
        for i, v in enumerate(values):
            v = v.strip()
            letters = sum(map(str.isalpha, v))
            digits = sum(map(str.isdigit, v))
            out[i] = len(v), letters, digits, len(v) - letters - digits, bare(v) in known.value, v.endswith(STOPS[:3]), bool(BULLET.match(v)), v[:1].islower(), bool(WORD.search(v)), 0
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = Lookup(traits)
        for t in word_tables(batches):
            page, block, line = (t.column(c).to_numpy() for c in ("page_id", "block_idx", "line_idx"))
            x0, x1 = (t.column(c).to_numpy() for c in ("x0", "x1"))
            q = look_up(t.column("value"))
            part = t.column("part").to_numpy()
            new_block = starts(page, block, t.column("chunk").to_numpy(), part)
            new_line = new_block | starts(line)
            at = np.flatnonzero(new_block)
            last = np.append(new_line[1:], True)
            head = new_line & (line == 0)
            gap = np.zeros(len(x0), np.float32)
            gap[1:] = x0[1:] - x1[:-1]
            real = ~new_line & np.isfinite(gap)
            real[1:] &= np.isfinite(x0[1:]) & np.isfinite(x1[:-1])
            # a bullet may stand alone or before a lower-case word; the word behind it tells no sentence
            total = lambda m: np.add.reduceat(m.astype(np.int64), at)
            mean = lambda c: t.column(c).to_numpy().astype(np.float64)
            conf, obj = mean("confidence"), mean("objectness")
            counts = [
                total(np.ones(len(page))), total(q[:, 0]), total(q[:, 1]), total(q[:, 2]), total(q[:, 3]), total(q[:, 4]),
                total(real & (gap > WIDE_GAP)), total(real), total(new_line), total(last & (q[:, 5] > 0)), total(new_line & (q[:, 6] > 0)),
                total(new_line & (q[:, 7] > 0)), total(head & (q[:, 7] > 0)), total(np.isfinite(conf)), total(np.isfinite(obj)),
                np.add.reduceat(np.nan_to_num(conf), at), np.add.reduceat(np.nan_to_num(obj), at),
            ]
            long = np.flatnonzero(new_line & ((part > 0) | (np.diff(np.append(np.flatnonzero(new_line), len(page)))[np.cumsum(new_line) - 1] >= LONG)))
            states, offsets = None, np.zeros(len(at) + 1, np.int32)
            end = np.append(np.flatnonzero(new_line)[1:], len(page))[np.cumsum(new_line)[long] - 1] - 1
            place = lambda x, i: pa.array(np.where(np.isfinite(x[i]), x[i], 0).astype(np.float32), mask=~np.isfinite(x[i]))
            columns = [pa.array(line[long].astype(np.int32)), pa.array(part[long].astype(np.int32)), place(x0, long), place(x1, end), *(pa.array(c > 0) for c in (q[end, 5], q[long, 6], q[long, 7], q[long, 7] * (line[long] == 0)))]
            offsets[1:] = np.cumsum(np.bincount(np.searchsorted(at, long, side="right") - 1, minlength=len(at)))
            states = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, [f.split()[0] for f in STATE.split(", ")]))
            yield pa.RecordBatch.from_arrays([pa.array(page[at]), pa.array(block[at].astype(np.int32)), *map(pa.array, counts), states], ["page_id", "block_idx", *COUNTS, *SUMS, "states"])

    state = ", ".join(f"{f.split()[0]}: {f.split()[1]}" for f in STATE.split(", "))
    schema = f"page_id {words.schema['page_id'].dataType.simpleString()}, block_idx int" + "".join(f", {c} long" for c in COUNTS) + "".join(f", {c} double" for c in SUMS) + f", states array<struct<{state}>>"
    chunks = rows.mapInArrow(run, schema)
    blocks = chunks.groupBy("page_id", "block_idx").agg(*(F.sum(c).alias(c) for c in [*COUNTS, *SUMS]), F.sort_array(F.flatten(F.collect_list(F.when(F.size("states") > 0, F.col("states"))))).alias("states"))
    return corrected(blocks).drop("states")


def corrected(blocks: DataFrame) -> DataFrame:
    """Counts of blocks after the parts of their lines, in order, have met (a state for 512 words at most)."""
    met = F.filter(
        F.zip_with(F.col("states"), F.concat(F.array(F.lit(None)), F.col("states")), lambda b, a: F.struct(a.alias("a"), b.alias("b"))),
        lambda s: s["a"].isNotNull() & s["b"].isNotNull() & (s["a"]["line_idx"] == s["b"]["line_idx"]),
    )
    number = lambda test: F.size(F.filter(F.col("met"), test))
    gap = lambda s: s["b"]["x0"] - s["a"]["x1"]
    less = {"n_lines": lambda s: F.lit(True), "n_stops": lambda s: s["a"]["stop"], "n_bullets": lambda s: s["b"]["bullet"], "n_small": lambda s: s["b"]["small"], "n_head_small": lambda s: s["b"]["head_small"]}
    more = {"n_gaps": lambda s: gap(s).isNotNull(), "n_wide": lambda s: F.coalesce(gap(s) > WIDE_GAP, F.lit(False))}
    out = blocks.withColumn("met", met)
    return out.withColumns({c: F.col(c) - number(t) for c, t in less.items()} | {c: F.col(c) + number(t) for c, t in more.items()}).drop("met")


def with_kinds(blocks: DataFrame) -> DataFrame:
    """Adds ``kind`` of each block: prose, list, table or junk."""
    share = lambda a, b: F.col(a) / F.greatest(F.lit(1), F.col(b))
    table = (share("n_wide", "n_words") >= 0.12) & (share("n_common", "n_words") >= 0.12)
    junk = (share("n_common", "n_words") < 0.3) & (F.col("n_words") >= 8)
    bullets = (share("n_bullets", "n_lines") >= 0.5) & (F.col("n_lines") >= 2)
    plain = (F.col("n_head_small") > 0) & (share("n_small", "n_lines") >= 0.7) & (F.col("n_lines") >= 3) & (share("n_stops", "n_lines") < 0.1)
    return blocks.withColumn("kind", F.when(table, "table").when(bullets | plain, "list").when(junk, "junk").otherwise("prose"))


def page_statistics(words: DataFrame, common: set[str] | None = None) -> DataFrame:
    """Statistics of each page and its ``kind``."""
    blocks = with_kinds(block_counts(words, common))
    kinds = ["list", "table", "junk"]
    pages = blocks.groupBy("page_id").agg(
        *(F.sum(c).alias(c) for c in [*COUNTS, *SUMS]), *(F.sum(F.when(F.col("kind") == k, F.col("n_words")).otherwise(0)).alias(f"words_{k}") for k in kinds)
    )
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    most = F.greatest(*(F.col(f"words_{k}") for k in kinds))
    unknown = ratio("n_common", "n_words") < 0.3
    kind = F.when(sum(F.col(f"words_{k}") for k in kinds) * 2 > F.col("n_words"), F.coalesce(*(F.when(F.col(f"words_{k}") == most, k) for k in ("junk", "table", "list")))).when(unknown, "junk").otherwise("prose")
    return pages.select(
        "page_id", "n_words", "n_lines", ratio("n_chars", "n_words").alias("mean_word_length"), ratio("n_symbols", "n_chars").alias("symbol_ratio"), ratio("n_digits", "n_chars").alias("digit_ratio"),
        ratio("n_stops", "n_lines").alias("stop_line_share"), ratio("n_common", "n_words").alias("common_word_share"), ratio("n_bullets", "n_lines").alias("bullet_line_share"), ratio("n_wide", "n_gaps").alias("wide_gap_share"),
        ratio("sum_confidence", "n_confidence").alias("mean_confidence"), ratio("sum_objectness", "n_objectness").alias("mean_objectness"), *(f"words_{k}" for k in kinds), kind.alias("kind"),
    )
