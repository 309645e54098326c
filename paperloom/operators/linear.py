"""Pages as ordered items: what every export of a page starts from.

Lines and tables are ordered together, labelled by the layout regions that cover
them and joined to items: a table is one, the lines of a segment are one, and the
lines of a list entry, which one region covers, are one whatever the segments.
All but the order itself are joins, windows and aggregates keyed by page.

Defined results: without regions every label is null; a page without elements has
no items; a page of unknown language and without letters reads from left to right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normal_label, text_direction
from ..session import checkpoint
from .reading import covering_labels, in_reading_order, page_reading_order, reading_segments

BOX = ["x0", "y0", "x1", "y1"]


def page_directions(lines: DataFrame, keys: list[str], languages: DataFrame | None = None) -> DataFrame:
    """``direction`` of each page by the strong letters of all its words; a tie follows the language."""
    texts = lines.select(*keys, F.array_join(F.transform("words", lambda w: w["value"]), " ").alias("t"))
    right = texts.withColumn("d", F.when(text_direction(F.col("t"), F.lit(None)) == "rtl", F.length("t")).otherwise(-F.length("t")))
    if languages is None:
        return right.groupBy(*keys).agg(F.when(F.sum("d") > 0, "rtl").otherwise("ltr").alias("direction"))
    sums = right.groupBy(*keys).agg(F.sum("d").alias("d")).join(languages, keys, "left")
    return sums.select(*keys, F.when(F.col("d") > 0, "rtl").when(F.col("d") < 0, "ltr").otherwise(text_direction(F.lit(""), F.col("language"))).alias("direction"))


def ordered_words(words: Column, direction: Column) -> Column:
    """Values of a line's words in the order they are read: as stored, from the right, or from the top."""
    middle = lambda a, b: lambda w: (w[a] + w[b]) / 2
    by = lambda key: F.transform(F.array_sort(F.transform(words, lambda w, i: F.struct(key(w).alias("k"), i.alias("i"), w["value"].alias("value")))), lambda s: s["value"])
    return F.when(direction.startswith("ttb"), by(middle("y0", "y1"))).when(direction == "rtl", by(lambda w: -(w["x0"] + w["x1"]) / 2)).otherwise(F.transform(words, lambda w: w["value"]))


def line_direction(words: Column, direction: Column, auto: bool) -> Column:
    """Direction of one line: its own where the page's was inferred, so a quotation in another script keeps its order."""
    if not auto:
        return direction
    own = text_direction(F.array_join(F.transform(words, lambda w: w["value"]), " "), F.lit(None))
    return F.when(direction.startswith("ttb") | (F.size(words) <= 1), direction).otherwise(own)


def page_items(lines: DataFrame, keys: list[str], regions: DataFrame | None = None, tables: DataFrame | None = None, direction: str = "auto", languages: DataFrame | None = None) -> DataFrame:
    """``position, label, lines, table, elements`` of each item of a page, in reading order.

    ``lines``: keys, ``line_idx``, box, ``words`` (array of value and box);
    ``regions``: keys, ``region_idx, type``, box; ``tables``: keys,
    ``table_idx``, box, ``text``.  ``elements`` are the line numbers of an item.
    """
    none = lambda t: F.lit(None).cast(t)
    word = lines.schema["words"].dataType.simpleString()
    parts = lines.select(*keys, F.col("line_idx").cast("long").alias("element"), *BOX, "words", none("string").alias("table"))
    if tables is not None:
        parts = parts.union(tables.select(*keys, (-1 - F.col("table_idx")).cast("long").alias("element"), *BOX, none(word).alias("words"), F.col("text").alias("table")))
    if regions is None:
        parts = parts.withColumns({"type": none("string"), "region_idx": none("long")})
    else:
        parts = covering_labels(parts, regions, keys, "element")
    label = F.when(F.col("table").isNotNull(), "Table").otherwise(F.col("type"))
    parts = parts.withColumn("label", label)
    auto = direction == "auto"
    if auto:
        parts = parts.join(page_directions(lines, keys, languages), keys, "left").withColumn("direction", F.coalesce("direction", F.lit("ltr")))
    else:
        parts = parts.withColumn("direction", F.lit(direction))
    parts = checkpoint(parts)  # read for the order and again with it
    order = page_reading_order(parts, keys, "element", "label", "direction")
    segments = reading_segments(parts.join(order, [*keys, "element"]), keys, label="label", direction="direction")
    at = Window.partitionBy(*keys).orderBy("position")
    listed = (normal_label(F.col("label")) == "list_item") & F.col("table").isNull()
    before = {c: F.lag(c).over(at) for c in ("segment_idx", "region_idx", "_listed")}
    segments = segments.withColumn("_listed", listed)
    joined = F.when(F.col("_listed"), before["_listed"] & (before["region_idx"] == F.col("region_idx"))).otherwise((before["segment_idx"] == F.col("segment_idx")) & ~before["_listed"])
    numbered = segments.withColumn("_new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).withColumn("_item", F.sum("_new").over(at) - 1)
    text = F.array_join(ordered_words(F.col("words"), line_direction(F.col("words"), F.col("direction"), auto)), " ")
    one = F.struct("position", F.when(F.col("table").isNull(), text).alias("line"), "element")
    items = numbered.groupBy(*keys, F.col("_item").alias("position")).agg(F.min_by("label", "position").alias("label"), F.sort_array(F.collect_list(one)).alias("e"), F.max("table").alias("table"), F.first("direction").alias("direction"))
    return items.select(*keys, "position", "label", F.filter(F.transform("e", lambda s: s["line"]), lambda t: t.isNotNull()).alias("lines"), "table", F.transform("e", lambda s: s["element"]).alias("elements"), "direction")


def attached_artefacts(items: DataFrame, lines: DataFrame, artefacts: DataFrame, keys: list[str]) -> DataFrame:
    """``position`` of the item each artefact goes with: that of the first line of its block, else the page's last item of lines.

    ``lines``: keys, ``line_idx, block_idx``; ``artefacts``: keys, ``block_idx, artefact_idx``.
    """
    owner = items.select(*keys, "position", F.explode("elements").alias("line_idx")).join(lines.select(*keys, "line_idx", "block_idx"), [*keys, "line_idx"])
    first = owner.groupBy(*keys, "block_idx").agg(F.min("position").alias("position"))
    last = items.filter("table is null").groupBy(*keys).agg(F.max("position").alias("_last"))
    return artefacts.join(first, [*keys, "block_idx"], "left").join(last, keys, "left").select(*keys, "block_idx", "artefact_idx", F.coalesce("position", "_last").alias("position"))


def ordered_predictions(predictions: DataFrame, keys: list[str], direction: str = "ltr") -> DataFrame:
    """Predictions of key information with ``position``: their reading order inside the page and class, in which their rows come; without a page or class they have none and are left out."""
    within = [*keys, "class_idx"]
    rest = [c for c in predictions.columns if c not in (*within, "position")]
    placed = predictions.filter(" and ".join(f"{c} is not null" for c in within)).select(*within, *rest)
    numbered = placed.withColumn("_n", F.row_number().over(Window.partitionBy(*within).orderBy("y0", "x0", "value")))
    return in_reading_order(numbered, "_n", direction)


def reordered_blocks(items: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks rebuilt from ordered items: ``block_idx, line_idx, element``, tables left out."""
    kept = items.filter("table is null")
    block = F.row_number().over(Window.partitionBy(*keys).orderBy("position")).cast("long") - 1
    return kept.withColumn("block_idx", block).select(*keys, "block_idx", F.posexplode("elements").alias("line_idx", "element"))
