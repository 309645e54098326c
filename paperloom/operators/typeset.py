"""Words typeset from document texts on an integer grid: a deterministic stand-in for a detector."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pixels of a page, a column and a line; lines of a page.
WIDTH, HEIGHT, COLUMN, LINE, LINES, COLUMNS = 800, 1000, 10, 25, 40, 80


def typeset_words(documents: DataFrame) -> DataFrame:
    """``doc_id, page_idx, word_idx, value, x0, y0, x1, y1, confidence_pct`` in reading order."""
    tokens = F.filter(F.split("text", r"[ \t\n\r\f]+"), lambda t: t != "")
    rows = documents.filter("text is not null").select("doc_id", F.posexplode(tokens).alias("idx", "value")).withColumn("idx", F.col("idx").cast("long"))
    n = F.char_length("value").cast("long")
    so_far = F.sum(n + 1).over(Window.partitionBy("doc_id").orderBy("idx"))
    rows = rows.withColumn("n", n).withColumn("col", so_far - F.col("n") - 1)
    line = F.expr(f"col div {COLUMNS}")
    x0 = F.col("col") % COLUMNS * COLUMN
    y0 = line % LINES * LINE + (F.col("idx") * 7 + F.col("doc_id") * 3) % 5
    return rows.select("doc_id", F.expr(f"col div {COLUMNS} div {LINES}").alias("page_idx"), F.col("idx").alias("word_idx"), "value", x0.alias("x0"), y0.alias("y0"), F.least(x0 + F.col("n") * COLUMN, F.lit(WIDTH)).alias("x1"), (y0 + 18).alias("y1"), (50 + (F.col("idx") * 11 + F.col("doc_id")) % 50).alias("confidence_pct"))


def predicted_words(words: DataFrame) -> DataFrame:
    """A recogniser's stand-in: words dropped, shifted, and read in four ways."""
    kept = words.filter((F.col("word_idx") * 31 + F.col("doc_id") * 17) % 20 != 0)
    shift = (F.col("word_idx") * 13 + F.col("doc_id")) % 7 - 3
    value = F.when(F.col("word_idx") % 4 == 1, F.upper("value")).when(F.col("word_idx") % 4 == 3, F.substring("value", 1, 3)).otherwise(F.col("value"))
    return kept.withColumns({"x0": F.col("x0") + shift, "x1": F.col("x1") + shift, "value": value})
