"""Recognition as a chain of table functions with pluggable models.

A detector turns a batch of pages into boxes, a recogniser a batch of crops into
texts; both are plain functions run on executors over Arrow batches.  The engine
ships deterministic stand-ins, not models.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import FOLD, merge_all
from .linear import ordered_predictions

Detector = Callable[[pd.DataFrame], pd.DataFrame]
Recogniser = Callable[[pd.Series], pd.DataFrame]
BOXES = "page_id long, class string, word_idx long, x0 double, y0 double, x1 double, y1 double, score double"


def detect(pages: DataFrame, detector: Detector, hooks: list[Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Boxes of pages, without empty ones; hooks rewrite them before recognition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield detector(b)

    boxes = pages.mapInPandas(run, BOXES).filter("x1 > x0 and y1 > y0")
    for hook in hooks or []:
        boxes = boxes.transform(hook)
    return boxes


def recognise(crops: DataFrame, recogniser: Recogniser, column: str = "crop") -> DataFrame:
    """Adds ``value`` and ``confidence`` of every crop."""

    @F.pandas_udf("value string, confidence double")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in series:
            yield recogniser(s)

    return crops.withColumn("_r", run(column)).select("*", "_r.value", "_r.confidence").drop("_r")


def regroup(parts: DataFrame, keys: list[str], overlap: float = 0.5, last_overlap: float = 0.5) -> DataFrame:
    """Readings of the windows of a wide crop as one: texts merged, confidences averaged."""

    @F.pandas_udf("string")
    def merge(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: merge_all(list(t), overlap, last_overlap))

    lists = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("window_idx", "value"))).alias("w"), F.avg("confidence").alias("confidence"))
    return lists.select(*keys, merge(F.transform("w", lambda w: w["value"])).alias("value"), "confidence")


def whitelisted(candidates: DataFrame, allowed: str, keys: list[str]) -> DataFrame:
    """Best allowed character of each step: candidates outside the alphabet are masked before the choice."""
    return candidates.filter(F.col("char").isin(*allowed)).groupBy(*keys).agg(F.max_by("char", F.struct("score", "char")).alias("char"), F.max("score").alias("score"))


def nearest_allowed(vocabulary: str, allowed: str) -> dict[str, str]:
    """For every character outside the alphabet an allowed one with the same plain form, if there is one: the same case before the other."""
    plain = lambda c: unicodedata.normalize("NFKD", FOLD.get(c, c)).encode("ascii", "ignore").decode()
    by: dict[str, str] = {}
    for c in allowed:
        by.setdefault(plain(c), c)
        by.setdefault(plain(c).swapcase(), c)
    return {c: by[plain(c)] for c in vocabulary if c not in allowed and plain(c) and plain(c) in by}


def restricted(candidates: DataFrame, vocabulary: str, allowed: str, keys: list[str], strategy: str = "mask", mapping: dict[str, str] | None = None) -> DataFrame:
    """Best allowed character of each step.

    ``mask`` leaves other characters out; ``nearest`` counts a character for the
    allowed one of the same plain form (or of ``mapping``), taking the better
    score, before the choice.
    """
    if strategy not in ("mask", "nearest"):
        raise ValueError("strategy must be 'mask' or 'nearest'")
    if not allowed or set(allowed) - set(vocabulary):
        raise ValueError("allowed characters must be some of the vocabulary")
    if strategy == "nearest":
        pairs = [F.lit(x) for p in (mapping or nearest_allowed(vocabulary, allowed)).items() for x in p]
        candidates = candidates.withColumn("char", F.coalesce(F.create_map(*pairs)[F.col("char")], F.col("char"))) if pairs else candidates
    return whitelisted(candidates, allowed, keys)


def kie_pages(pages: DataFrame, detector: Detector, recogniser: Recogniser | None = None) -> DataFrame:
    """Key information of pages: recognised boxes with the class the detector gave them, in reading order inside it."""
    words = read_pages(pages, detector, recogniser or echo_recogniser)
    index = words.select("class").distinct().withColumn("class_idx", F.row_number().over(Window.orderBy("class")).cast("long") - 1)  # a row for each class
    return ordered_predictions(words.join(F.broadcast(index), "class"), ["page_id"])


def table_cells(regions: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], keys: list[str], label: str = "Table") -> DataFrame:
    """Cells of every table region by a model that sees one region in coordinates of its own, mapped back to the page.

    The model turns rows of regions into ``region_idx``, keys, ``cell_idx, x0,
    y0, x1, y1`` (0..1 in the region) and ``row_start, row_end, col_start, col_end``.
    """
    tables = regions.filter(F.col("type") == label)
    kinds = ", ".join(f"{k} {regions.schema[k].dataType.simpleString()}" for k in [*keys, "region_idx"])
    cells = tables.mapInPandas(lambda bs: map(model, bs), f"{kinds}, cell_idx long, x0 double, y0 double, x1 double, y1 double, row_start int, row_end int, col_start int, col_end int")
    place = tables.select(*keys, "region_idx", *(F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")))
    back = {c: F.col(f"_{a}0") + F.col(c) * (F.col(f"_{a}1") - F.col(f"_{a}0")) for a in "xy" for c in (f"{a}0", f"{a}1")}
    return cells.join(place, [*keys, "region_idx"]).withColumns(back).drop("_x0", "_y0", "_x1", "_y1")


def grid_detector(pages: pd.DataFrame) -> pd.DataFrame:
    """Stand-in: a row of boxes a page, one for each token of its text."""
    rows = []
    for page, text in zip(pages.page_id, pages.text):
        x = 0.0
        for k, t in enumerate((text or "").split()):
            rows.append((page, "words", k, x, 0.0, x + len(t), 1.0, 1.0))
            x += len(t) + 1
    return pd.DataFrame(rows, columns=["page_id", "class", "word_idx", "x0", "y0", "x1", "y1", "score"])


def echo_recogniser(crops: pd.Series) -> pd.DataFrame:
    """Stand-in: the crop is its text."""
    return pd.DataFrame({"value": crops, "confidence": [1.0] * len(crops)})


def read_pages(pages: DataFrame, detector: Detector = grid_detector, recogniser: Recogniser = echo_recogniser) -> DataFrame:
    """Pages to recognised words: detect, cut, recognise."""
    boxes = detect(pages.select("page_id", "text"), detector)
    cut = F.expr("substring(normal, cast(x0 as int) + 1, cast(x1 - x0 as int))")
    crops = boxes.join(pages.select("page_id", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("normal")), "page_id").select("page_id", "class", "word_idx", "x0", "y0", "x1", "y1", "score", cut.alias("crop"))
    return recognise(crops, recogniser).drop("crop")
