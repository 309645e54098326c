"""Evaluation of recognised documents against truth.

The general matching (an assignment that maximises the total IoU of a page) is
an Arrow kernel on the pages' boxes, first split into groups that overlap, so
the assignment problems stay tiny.  Its results are counts, which Spark sums.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import folded, match_levels
from ..session import checkpoint
from .boxes import iou_matrix
from .lines import components


def text_match(pairs: DataFrame, a: str = "truth", b: str = "predicted", by: list[str] | None = None) -> DataFrame:
    """Shares of equal texts at four levels; no row where there is no pair."""
    levels = match_levels(F.col(a), F.col(b))
    return pairs.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), *((F.sum(v.cast("int")) / F.count(F.lit(1))).alias(k) for k, v in levels.items()))


def assignment(gain: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows and columns of greatest total gain (shortest augmenting paths with potentials)."""
    turned = gain.shape[0] > gain.shape[1]
    cost = -(gain.T if turned else gain)
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while owner[j]:
            used[j] = True
            row = owner[j]
            slack = np.append(np.inf, cost[row - 1] - u[row] - v[1:])
            better = ~used & (slack < least)
            least[better], way[better] = slack[better], j
            free = np.where(used, np.inf, least)
            k = int(free.argmin())
            step = free[k]
            u[owner[used]] += step
            v[used] -= step
            least[~used] -= step
            j = k
        while j:
            owner[j], j = owner[way[j]], way[j]
    pairs = [(int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return [(b, a) for a, b in pairs] if turned else pairs


def best_pairs(gain: np.ndarray) -> list[tuple[int, int]]:
    """``assignment`` in each group of rows and columns that overlap at all."""
    r, c = np.nonzero(gain > 0)
    if not len(r):
        return []
    alone = (np.bincount(r, minlength=gain.shape[0])[r] == 1) & (np.bincount(c, minlength=gain.shape[1])[c] == 1)
    out = list(zip(r[alone].tolist(), c[alone].tolist()))  # no other overlap competes
    r, c = r[~alone], c[~alone]
    if not len(r):
        return out
    group = components(sum(gain.shape), r, c + gain.shape[0])
    for g in np.unique(group[r]):
        rows, cols = np.flatnonzero(group[: gain.shape[0]] == g), np.flatnonzero(group[gain.shape[0] :] == g)
        out += [(int(rows[a]), int(cols[b])) for a, b in assignment(gain[np.ix_(rows, cols)])]
    return [(a, b) for a, b in out if gain[a, b] > 0]


def page_matches(truth: DataFrame, predicted: DataFrame, keys: list[str], equal: dict[str, Callable[[], Column]] | None = None, threshold: float = 0.5) -> DataFrame:
    """Per page: ``n_truth, n_predicted, n_matched, sum_iou`` and, for each name of ``equal``, the matched pairs with equal values of its column."""
    named = [(f"_{k}", f()) for k, f in (equal or {}).items()]
    names = [n for n, _ in named]
    boxes = ["x0", "y0", "x1", "y1"]

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf.is_truth], pdf[~pdf.is_truth]
        out = {k: [pdf[k].iloc[0]] for k in keys}
        gain = iou_matrix(a[boxes].to_numpy(float), b[boxes].to_numpy(float))
        hits = [(i, j) for i, j in best_pairs(gain) if gain[i, j] >= threshold]
        i, j = np.array(hits, int).reshape(-1, 2).T
        same = {f"n{c}": [int((a[c].to_numpy()[i] == b[c].to_numpy()[j]).sum())] for c in names}
        total = float(gain.max(axis=0).sum()) if gain.size else 0.0
        return pd.DataFrame(out | {"n_truth": [len(a)], "n_predicted": [len(b)], "n_matched": [len(hits)], "sum_iou": [total]} | same)

    types = ", ".join(f"{k} {truth.schema[k].dataType.simpleString()}" for k in keys)
    pick = lambda d, t: d.select(*keys, *boxes, *(c.alias(n) for n, c in named), F.lit(t).alias("is_truth"))
    both = pick(truth, True).unionByName(pick(predicted, False))
    return both.groupBy(*keys).applyInPandas(page, f"{types}, n_truth long, n_predicted long, n_matched long, sum_iou double" + "".join(f", n{c} long" for c in names))


def text_levels(value: str) -> dict[str, Callable[[], Column]]:
    """The four levels at which texts are compared, as columns to be equal."""
    v = F.col(value)
    return {"raw": lambda: v, "caseless": lambda: F.lower(v), "folded": lambda: folded(v), "unicase": lambda: F.lower(folded(v))}


def localisation(pages: DataFrame) -> DataFrame:
    """Recall, precision and mean IoU (two decimals) of page counts, and both for each equality counted; null for an empty side."""
    s = {c: F.sum(c) for c in pages.columns if c.startswith("n_")}
    share = lambda a, b, name: F.try_divide(s[a], s[b]).alias(name)
    equal = [c for c in s if c not in ("n_truth", "n_predicted", "n_matched")]
    return pages.agg(share("n_matched", "n_truth", "recall"), share("n_matched", "n_predicted", "precision"), F.bround(F.try_divide(F.sum("sum_iou"), s["n_predicted"]), 2).alias("mean_iou"), *(share(c, n, f"{c[2:]}_{k}") for c in equal for n, k in (("n_truth", "recall"), ("n_predicted", "precision"))))


def ocr_metric(truth: DataFrame, predicted: DataFrame, keys: list[str], value: str = "value", threshold: float = 0.5) -> DataFrame:
    """Recall and precision of words found and read alike, at four levels, and the mean IoU."""
    return localisation(page_matches(truth, predicted, keys, text_levels(value), threshold))


def detection_metric(truth: DataFrame, predicted: DataFrame, keys: list[str], label: str, threshold: float = 0.5) -> DataFrame:
    """Recall and precision of boxes found with the right class, and the mean IoU."""
    s = localisation(page_matches(truth, predicted, keys, {"class": lambda: F.col(label)}, threshold))
    return s.select(F.col("class_recall").alias("recall"), F.col("class_precision").alias("precision"), "mean_iou")


def cell_metric(truth: DataFrame, predicted: DataFrame, keys: list[str], threshold: float = 0.5) -> DataFrame:
    """Recall, precision and F1 of table cells, and the share of matched cells at the right rows and columns."""
    place = lambda: F.concat_ws(",", "col_start", "col_end", "row_start", "row_end")
    s = page_matches(truth, predicted, keys, {"place": place}, threshold).agg(*(F.sum(c).alias(c) for c in ("n_truth", "n_predicted", "n_matched", "n_place")))
    n = {c: F.col(c) for c in s.columns}
    f1 = F.when((n["n_truth"] > 0) & (n["n_predicted"] > 0), F.try_divide(2 * n["n_matched"], F.when(n["n_matched"] > 0, n["n_truth"] + n["n_predicted"])))
    return s.select(F.try_divide(n["n_matched"], n["n_truth"]).alias("recall"), F.try_divide(n["n_matched"], n["n_predicted"]).alias("precision"), f1.alias("f1"), F.try_divide(n["n_place"], n["n_matched"]).alias("structure_accuracy"))


def mutual_best(pairs: DataFrame, truth: str, predicted: str, keys: list[str]) -> DataFrame:
    """Pairs that are the best of both sides; where overlaps do not compete this is the assignment."""
    a = Window.partitionBy(*keys, truth).orderBy(F.desc("iou"), predicted)
    b = Window.partitionBy(*keys, predicted).orderBy(F.desc("iou"), truth)
    return pairs.withColumn("_a", F.row_number().over(a)).withColumn("_b", F.row_number().over(b)).filter("_a = 1 and _b = 1").drop("_a", "_b")


def running_count(rows: DataFrame, by: list[str], name: str, score: str = "score", order: str = "order") -> DataFrame:
    """Adds the number of rows up to each, itself included, in its group, from the best score down, ties by ``order``.

    Rows are range-partitioned by group, score and order, so that neither a large
    group nor a frequent score is one task's; a row's place is its place in its
    partition and what the partitions before hold of its group, a table of a row
    for each partition and group.
    """
    keys = [*by, F.desc(score), F.col(order)]
    placed = checkpoint(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33).alias("_part")
    sizes = placed.groupBy(*by, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    so_far = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0))).drop("_n")
    found = placed.withColumn("_part", part).join(F.broadcast(sizes), [*by, "_part"])  # partitions plus groups rows
    return found.withColumn(name, F.col("_id") - F.col("_first") + F.col("_before") + 1).drop("_id", "_first", "_before", "_part")


def average_precision(detections: DataFrame, truths: DataFrame, by: str, thresholds: list[float]) -> DataFrame:
    """101-point interpolated average precision of each class and threshold.

    ``detections``: class, score, order (unique), and the id and IoU of the best
    truth.  A detection is true if its best truth reaches the threshold and no
    detection before it claimed that truth.  Recall levels are i * 0.01, compared
    with >=.  Precision has its peaks at true detections, so only these are
    followed beyond their place among all.
    """
    n = truths.groupBy(by).agg(F.count(F.lit(1)).alias("n_truth"))
    placed = running_count(detections.select(by, "score", "order", "truth_id", "iou"), [by], "seen")
    # The first claimant of a truth is the one with the least place; combined before the shuffle.
    claim = lambda t: F.min(F.when(F.col("iou") >= t, F.col("seen")))
    firsts = placed.filter("truth_id is not null").groupBy(by, "truth_id").agg(*(claim(t).alias(f"_{i}") for i, t in enumerate(thresholds)))
    true = firsts.select(by, F.explode(F.filter(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"_{i}").alias("seen")) for i, t in enumerate(thresholds))), lambda x: x["seen"].isNotNull())).alias("t")).select(by, "t.threshold", "t.seen")
    curve = running_count(true.withColumn("score", -F.col("seen")), [by, "threshold"], "tps", order="seen").join(n, by)
    curve = curve.select(by, "threshold", (F.col("tps") / F.col("n_truth")).alias("recall"), (F.col("tps") / F.col("seen")).alias("precision"))
    # The greatest precision at each recall level: levels are taken by recall, then a maximum runs from the end.
    level = F.floor(F.col("recall") * 100).cast("int")
    top = curve.withColumn("level", F.explode(F.filter(F.array(level - 1, level, level + 1), lambda i: (i >= 0) & (i <= 100) & (F.col("recall") >= i * 0.01)))).groupBy(by, "threshold", "level").agg(F.max("precision").alias("p"))
    grid = n.select(by, F.explode(F.array(*map(F.lit, thresholds))).alias("threshold")).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(100))))
    back = Window.partitionBy(by, "threshold").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    filled = grid.join(top, [by, "threshold", "level"], "left").withColumn("p", F.coalesce(F.max("p").over(back), F.lit(0.0)))
    return filled.groupBy(by, "threshold").agg((F.sum(F.bround("p", 12)) / 101).alias("ap"))


def detection_summary(detections: DataFrame, truths: DataFrame, by: str, thresholds: list[float] | None = None) -> DataFrame:
    """``map`` over all thresholds (0.5 to 0.95 in steps of 0.05), ``map_50`` and ``map_75``; classes without a truth are left out."""
    thresholds = thresholds or [round(0.5 + 0.05 * i, 2) for i in range(10)]
    ap = average_precision(detections, truths, by, thresholds).groupBy("threshold").agg(F.avg("ap").alias("ap"))
    at = lambda t: F.max(F.when(F.abs(F.col("threshold") - t) < 1e-9, F.col("ap")))
    return ap.agg(F.avg("ap").alias("map"), at(0.5).alias("map_50"), at(0.75).alias("map_75"))
