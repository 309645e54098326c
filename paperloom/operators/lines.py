"""Words to rows, lines and blocks.

Rows are an ordered fold inside a page, done with the ``aggregate`` function of
arrays, so no row leaves the JVM; lines split rows at wide gaps, by window
functions.  Blocks are the components of a graph of near lines.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_idx"]


def sorted_boxes(words: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """Adds ``rank``: order by x0 + 2 * y1 / median height."""
    height = F.percentile(F.col("y1") - F.col("y0"), F.lit(0.5)).over(Window.partitionBy(*keys))
    order = F.col("x0") + 2 * F.col("y1") / F.when(height > 0, height).otherwise(1.0)
    return words.withColumn("order_key", order).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("order_key", "word_idx")).cast("long"))


def resolve_rows(words: DataFrame, keys: list[str] = PAGE, size: tuple[int, int] = (800, 1000)) -> DataFrame:
    """Adds ``row_idx`` to every word.

    In the order of the sort key, a word joins the current row if its centre is
    nearer to the mean centre of the row than half the median height; rows
    passed are never looked at again, so a row is a stretch of that order.  The
    fold keeps only where rows start, and the words travel with it: one shuffle
    by page, no join back.  Coordinates are integers, so that the means are
    compared exactly: twice a centre is y0 + y1.  A page is one row of the
    shuffle, as in every operator that needs a page's words in order.
    """
    w, h = size
    rest = [c for c in words.columns if c not in keys]
    pages = words.groupBy(*keys).agg(F.percentile(F.col("y1") - F.col("y0"), F.lit(0.5)).alias("height"), F.collect_list(F.struct(*rest)).alias("w"))
    key = lambda x: F.struct((x["x0"] / w + 2 * (x["y1"] / h) / (F.col("height") / h)).alias("k"), x["word_idx"].alias("i"), x.alias("w"))
    pages = pages.select(*keys, "height", F.array_sort(F.transform("w", key)).alias("w"))
    start = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("at", "n", "total")), F.array().cast("array<int>").alias("starts"))

    def step(s, x):
        c = x["w"]["y0"] + x["w"]["y1"]
        joins = (s["n"] > 0) & (F.abs(c * s["n"] - s["total"]) < F.col("height") * s["n"])
        here = (s["at"] + 1).cast("int")
        return F.struct((s["at"] + 1).alias("at"), F.when(joins, s["n"] + 1).otherwise(F.lit(1).cast("long")).alias("n"), F.when(joins, s["total"] + c).otherwise(c).alias("total"), F.when(joins, s["starts"]).otherwise(F.concat(s["starts"], F.array(here))).alias("starts"))

    folded = pages.select(*keys, "w", F.aggregate("w", start, step, lambda s: s["starts"]).alias("starts"))
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("w") + 1))
    rows = F.zip_with("starts", ends, lambda a, b: F.slice("w", a, b - a))
    rows = folded.select(*keys, F.posexplode(rows).alias("row_idx", "r")).select(*keys, F.col("row_idx").cast("long").alias("row_idx"), F.explode("r").alias("r"))
    return rows.select(*keys, *(F.col(f"r.w.{c}").alias(c) for c in rest), "row_idx")


def resolve_lines(words: DataFrame, keys: list[str] = PAGE, break_px: int = 28) -> DataFrame:
    """``line_idx`` of every word: rows split where the gap to the word before is ``break_px`` or more."""
    in_row = Window.partitionBy(*keys, "row_idx").orderBy("x0", "word_idx")
    gap = F.col("x0") - F.lag("x1").over(in_row)
    breaks = resolve_rows(words, keys).withColumn("starts", F.when(gap.isNull() | (gap >= break_px), 1).otherwise(0))
    line = F.sum("starts").over(Window.partitionBy(*keys).orderBy("row_idx", "x0", "word_idx"))
    return breaks.withColumn("line_idx", line.cast("long") - 1).drop("starts")


def line_table(words: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """Lines with their text, box, number of words and mean confidence."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x0", "word_idx", "value"))), lambda s: s["value"]), " ")
    return words.groupBy(*keys, "line_idx").agg(text.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count(F.lit(1)).alias("n_words"), (F.sum("confidence_pct") / F.count(F.lit(1))).alias("confidence_pct"))


def components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Label of the component of each node: its least member."""
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(n)])


def resolve_blocks(lines: DataFrame, keys: list[str] = PAGE, size: tuple[int, int] = (800, 1000), cut: float = 0.1) -> DataFrame:
    """``block_idx`` of every line: single linkage, at ``cut``, on six features of its relative box."""
    w, h = size

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("line_idx")
        x0, y0, x1, y1 = (pdf[c].to_numpy(float) / s for c, s in (("x0", w), ("y0", h), ("x1", w), ("y1", h)))
        f = np.stack([(x0 + y1) / 2, (y0 + x1) / 2, (x0 + x1) / 2, (y0 + y1) / 2, x0, y0], axis=1)
        near = np.sqrt(((f[:, None] - f[None]) ** 2).sum(axis=2)) <= cut
        label = components(len(pdf), *np.nonzero(np.triu(near, 1)))
        return pdf[[*keys, "line_idx"]].assign(block_idx=pd.factorize(label)[0].astype("int64"))

    types = ", ".join(f"{k} {lines.schema[k].dataType.simpleString()}" for k in [*keys, "line_idx"])
    return lines.select(*keys, "line_idx", "x0", "y0", "x1", "y1").groupBy(*keys).applyInPandas(page, f"{types}, block_idx long")
