"""Joins and selections of boxes inside a page."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import sigmoid


def box_of(t: str) -> tuple[Column, ...]:
    return tuple(F.col(f"{t}.{c}") for c in ("x0", "y0", "x1", "y1"))


def overlap_pairs(left: DataFrame, right: DataFrame, keys: list[str], closed: bool = False, band: int = 64) -> DataFrame:
    """Pairs, as ``a`` and ``b``, of boxes of one page that overlap (or touch, if ``closed``).

    Boxes meet in horizontal bands of the page, not all with all; a pair counts
    in the band where its intersection begins, so none is made twice.
    """
    less = (lambda x, y: x <= y) if closed else (lambda x, y: x < y)
    spread = lambda df, t: df.withColumn("_band", F.explode(F.sequence(F.floor(F.col("y0") / band), F.floor(F.col("y1") / band)))).alias(t)
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_band"]]
    first = F.floor(F.greatest(F.col("a.y0"), F.col("b.y0")) / band) == F.col("a._band")
    return spread(left, "a").join(spread(right, "b"), [*same, first, less(F.col("a.x0"), F.col("b.x1")), less(F.col("b.x0"), F.col("a.x1")), less(F.col("a.y0"), F.col("b.y1")), less(F.col("b.y0"), F.col("a.y1"))])


def grid_pairs(left: DataFrame, right: DataFrame, cell: int) -> DataFrame:
    """Overlapping pairs over a plane without page keys: boxes meet in grid cells, each pair once.

    A pair counts in the cell of the upper left corner of its intersection, so
    no pair is made twice and none has to be taken out again.
    """
    def cells(df: DataFrame, t: str) -> DataFrame:
        xs = F.sequence(F.floor(F.col("x0") / cell), F.floor(F.col("x1") / cell))
        ys = F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))
        return df.withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys)).alias(t)

    a, b = cells(left, "a"), cells(right, "b")
    on = [F.col("a._cx") == F.col("b._cx"), F.col("a._cy") == F.col("b._cy"), F.col("a.x0") < F.col("b.x1"), F.col("b.x0") < F.col("a.x1"), F.col("a.y0") < F.col("b.y1"), F.col("b.y0") < F.col("a.y1")]
    first = (F.floor(F.greatest(F.col("a.x0"), F.col("b.x0")) / cell) == F.col("a._cx")) & (F.floor(F.greatest(F.col("a.y0"), F.col("b.y0")) / cell) == F.col("a._cy"))
    return a.join(b, on).filter(first)


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of all pairs of two box sets."""
    w = np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0])
    h = np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1])
    both = np.maximum(w, 0) * np.maximum(h, 0)
    size = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    union = size(a)[:, None] + size(b)[None] - both
    return np.divide(both, union, out=np.zeros_like(both, dtype=float), where=union > 0)


def clipped(subject: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Part of a convex polygon inside another, edge by edge of the window."""
    out = subject
    turn = np.sign(signed_area(window)) or 1.0
    for p, q in zip(window, np.roll(window, -1, axis=0)):
        if len(out) < 3:
            return np.zeros((0, 2))
        edge = q - p
        side = turn * (edge[0] * (out[:, 1] - p[1]) - edge[1] * (out[:, 0] - p[0]))
        kept = []
        for i in range(len(out)):
            a, b, sa, sb = out[i], out[(i + 1) % len(out)], side[i], side[(i + 1) % len(out)]
            if sa >= 0:
                kept.append(a)
            if (sa > 0 > sb) or (sa < 0 < sb):
                kept.append(a + (b - a) * sa / (sa - sb))
        out = np.array(kept).reshape(-1, 2)
    return out


def signed_area(p: np.ndarray) -> float:
    q = np.roll(p, -1, axis=0)
    return float((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum() / 2)


def polygon_iou(a: np.ndarray, b: np.ndarray) -> float:
    """IoU of two convex polygons; 0 for an empty union."""
    both = clipped(np.asarray(a, float), np.asarray(b, float))
    inter = abs(signed_area(both)) if len(both) >= 3 else 0.0
    union = abs(signed_area(np.asarray(a, float))) + abs(signed_area(np.asarray(b, float))) - inter
    return inter / union if union > 0 else 0.0


def least_rectangle(points: np.ndarray) -> np.ndarray:
    """Corners of the rectangle of least area around points, one side along an edge of their hull."""
    pts = np.unique(np.asarray(points, float), axis=0)
    if len(pts) < 3:
        low, high = pts.min(axis=0), pts.max(axis=0)
        return np.array([low, [high[0], low[1]], high, [low[0], high[1]]])

    def chain(order):
        out: list[np.ndarray] = []
        for p in order:
            while len(out) > 1 and np.cross(np.append(out[-1] - out[-2], 0), np.append(p - out[-2], 0))[2] <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    hull = np.array(chain(pts) + chain(pts[::-1]))
    best, corners = np.inf, None
    for p, q in zip(hull, np.roll(hull, -1, axis=0)):
        d = (q - p) / np.linalg.norm(q - p)
        turn = np.array([d, [-d[1], d[0]]])
        t = hull @ turn.T
        low, high = t.min(axis=0), t.max(axis=0)
        size = np.prod(high - low)
        if size < best - 1e-12:
            best, corners = size, np.array([low, [high[0], low[1]], high, [low[0], high[1]]]) @ turn
    return corners


def kept_boxes(boxes: np.ndarray, score: np.ndarray, index: np.ndarray, threshold: float) -> np.ndarray:
    """Places of the boxes that greedy suppression keeps: best score first, then the later index.

    All boxes that no better one in conflict with them can suppress any more are
    kept at once and theirs go; a few rounds give what the greedy loop gives.
    """
    order = np.lexsort((-index, -score))
    b = boxes[order]
    size = (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
    clash = iou_matrix(b, b) > threshold
    clash |= (size[:, None] <= 0) & (size <= 0)  # two empty boxes have no IoU and suppress each other
    better, worse = np.nonzero(np.triu(clash, 1))
    alive, kept = np.ones(len(b), bool), np.zeros(len(b), bool)
    while alive.any():
        blocked = np.zeros(len(b), bool)
        blocked[worse[alive[better]]] = True
        fresh = alive & ~blocked
        kept |= fresh
        alive &= blocked
        alive[worse[fresh[better]]] = False
    return order[kept]


def nms(boxes: DataFrame, keys: list[str], index: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Boxes of a page kept by greedy suppression: kept if the IoU with all kept before is at most the threshold.

    Pages come as arrays, many in a batch of Arrow, so a page costs no call of its own.
    """
    columns = ["x0", "y0", "x1", "y1", score]
    pages = boxes.groupBy(*keys).agg(*(F.collect_list(F.col(c).cast("double")).alias(f"_{c}") for c in columns), F.collect_list(index).alias("_index"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.num_columns - 1)
            ends = lists.offsets.to_numpy()
            value = np.stack([b.column(len(keys) + i).flatten().to_numpy(zero_copy_only=False) for i in range(len(columns))], axis=1)
            place = lists.flatten()
            at = place.to_numpy(zero_copy_only=False)
            ends = ends - ends[0]
            kept = [s + kept_boxes(value[s:e, :4], value[s:e, 4], at[s:e], threshold) for s, e in zip(ends, ends[1:])]
            of = pa.array(np.repeat(np.arange(b.num_rows), [len(k) for k in kept]))
            flat = pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(of) for i in range(len(keys))), place.take(flat)], [*keys, index])

    types = ", ".join(f"{k} {boxes.schema[k].dataType.simpleString()}" for k in [*keys, index])
    return pages.mapInArrow(run, types)


def containing_cells(words: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``table_idx, cell_idx``: the first cell (table, then cell) that contains a word's centre, else the nearest within half the median diagonal; words in none are left out.

    A page's cells are one array beside its words, so a word is one row throughout, whatever the number of cells.
    """
    table = Window.partitionBy(*keys, "table_idx")
    diagonal = F.sqrt((F.col("x1") - F.col("x0")) * (F.col("x1") - F.col("x0")) + (F.col("y1") - F.col("y0")) * (F.col("y1") - F.col("y0")))
    cells = cells.withColumns({"reach": F.percentile(diagonal, F.lit(0.5)).over(table) / 2, "tx0": F.min("x0").over(table), "ty0": F.min("y0").over(table), "tx1": F.max("x1").over(table), "ty1": F.max("y1").over(table)})
    pages = cells.groupBy(*keys).agg(F.collect_list(F.struct("table_idx", "cell_idx", "x0", "y0", "x1", "y1", "reach", "tx0", "ty0", "tx1", "ty1")).alias("_cells"))
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2

    def claim(c: Column) -> Column:
        inside = (cx >= c["x0"]) & (cx < c["x1"]) & (cy >= c["y0"]) & (cy < c["y1"])
        dx, dy = cx - (c["x0"] + c["x1"]) / 2, cy - (c["y0"] + c["y1"]) / 2
        distance = F.sqrt(dx * dx + dy * dy)
        near = (cx >= c["tx0"]) & (cx <= c["tx1"]) & (cy >= c["ty0"]) & (cy <= c["ty1"])
        cost = F.when(inside, c["cell_idx"].cast("double")).otherwise(distance)
        return F.when(near & (inside | (distance <= c["reach"])), F.struct(c["table_idx"].alias("table_idx"), F.when(inside, 0).otherwise(1).alias("rule"), cost.alias("cost"), c["cell_idx"].alias("cell_idx")))

    best = words.join(pages, keys).withColumn("_m", F.array_min(F.transform("_cells", claim))).filter("_m is not null")
    return best.select(*words.columns, F.col("_m.table_idx").alias("table_idx"), F.col("_m.cell_idx").alias("cell_idx"))


def cell_text(placed: DataFrame, keys: list[str]) -> DataFrame:
    """``value, confidence_pct, n_words`` of each cell: its words in rows from top to bottom, in a row from left to right.

    By their centres from the top a word joins the row if it lies less than half
    the median height of the cell's words below the mean centre of the row.
    """
    word = F.struct((F.col("y0") + F.col("y1")).alias("c"), (F.col("x0") + F.col("x1")).alias("x"), "word_idx", "value")
    grouped = placed.groupBy(*keys, "table_idx", "cell_idx").agg(F.sort_array(F.collect_list(word)).alias("w"), F.percentile(F.col("y1") - F.col("y0"), F.lit(0.5)).alias("height"), (F.sum("confidence_pct") / F.count(F.lit(1))).alias("confidence_pct"), F.count(F.lit(1)).alias("n_words"))
    height = F.when(F.col("height") > 0, F.col("height")).otherwise(1.0)
    row = "struct<row:bigint,x:bigint,word_idx:bigint,value:string>"
    start = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("row", "n", "total")), F.array().cast(f"array<{row}>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        joins = (s["n"] > 0) & (x["c"] * s["n"] - s["total"] < height * s["n"])
        number = F.when(joins | (s["n"] == 0), s["row"]).otherwise(s["row"] + 1)
        placed_ = F.struct(number.alias("row"), x["x"].alias("x"), x["word_idx"].alias("word_idx"), x["value"].alias("value"))
        return F.struct(number.alias("row"), F.when(joins, s["n"] + 1).otherwise(F.lit(1).cast("long")).alias("n"), F.when(joins, s["total"] + x["c"]).otherwise(x["c"]).alias("total"), F.concat(s["out"], F.array(placed_)).alias("out"))

    ordered = F.array_sort(F.aggregate("w", start, step, lambda s: s["out"]))
    return grouped.select(*keys, "table_idx", "cell_idx", F.array_join(F.transform(ordered, lambda x: x["value"]), " ").alias("value"), "confidence_pct", "n_words")


def polygon_ious(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of n pairs of convex quads at once (n x 4 x 2); 0 for an empty union.

    The vertices of an intersection are those of each inside the other and the
    crossings of their edges; sorted about their mean they give its area.
    """
    a, b = np.asarray(a, float), np.asarray(b, float)
    if not len(a):
        return np.zeros(0)
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    area = lambda p: cross(p, np.roll(p, -1, axis=1)).sum(axis=1) / 2
    size_a, size_b = area(a), area(b)

    def inside(p: np.ndarray, q: np.ndarray, turn: np.ndarray) -> np.ndarray:
        edge = np.roll(q, -1, axis=1) - q
        return (cross(edge[:, None], p[:, :, None] - q[:, None]) * turn[:, None, None] >= -1e-12).all(axis=2)

    ea, eb = np.roll(a, -1, axis=1) - a, np.roll(b, -1, axis=1) - b
    denominator = cross(ea[:, :, None], eb[:, None])
    between = b[:, None] - a[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(between, eb[:, None]) / denominator, cross(between, ea[:, :, None]) / denominator
        meet = a[:, :, None] + t[..., None] * ea[:, :, None]
    good = (np.abs(denominator) > 1e-15) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    points = np.concatenate([a, b, meet.reshape(len(a), -1, 2)], axis=1)
    valid = np.concatenate([inside(a, b, np.sign(size_b)), inside(b, a, np.sign(size_a)), good.reshape(len(a), -1)], axis=1)
    points = np.where(valid[..., None], points, 0)
    middle = points.sum(axis=1) / np.maximum(valid.sum(axis=1), 1)[:, None]
    d = points - middle[:, None]
    order = np.argsort(np.where(valid, np.arctan2(d[..., 1], d[..., 0]), np.inf), axis=1)
    ring, on = np.take_along_axis(d, order[..., None], axis=1), np.take_along_axis(valid, order, axis=1)
    ring = np.where(on[..., None], ring, ring[:, :1])  # what is no vertex repeats the first
    shared = np.where(valid.sum(axis=1) >= 3, np.abs(area(ring)), 0)
    union = np.abs(size_a) + np.abs(size_b) - shared
    return np.divide(shared, union, out=np.zeros(len(a)), where=union > 0)


def polygon_iou_column() -> object:
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        quads = lambda s: np.stack([np.stack(x) for x in s]).reshape(len(s), 4, 2)
        return pd.Series(polygon_ious(quads(a), quads(b)) if len(a) else [])

    return run


def polygon_nms(polygons: DataFrame, keys: list[str], index: str, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Quads kept by greedy suppression inside each class of a page: gone if the IoU with one kept before reaches the threshold.

    ``polygon``: eight numbers.  Ties of the score go to the lower index.
    """
    pages = polygons.groupBy(*keys, label).agg(F.sort_array(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col(index).alias("i"), F.col("polygon")))).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, kept = [], []
            for k, quads in enumerate(b.column(b.num_columns - 1).to_pylist()):
                q = np.array([x["polygon"] for x in quads], float).reshape(-1, 4, 2)
                low, high = q.min(axis=1), q.max(axis=1)
                near = ((low[:, None] <= high) & (low <= high[:, None])).all(axis=2)
                i, j = np.nonzero(np.triu(near, 1))
                clash = polygon_ious(q[i], q[j]) >= threshold
                i, j = i[clash], j[clash]
                alive = np.ones(len(q), bool)
                for n in np.unique(i).tolist():  # only quads in conflict, best first
                    if alive[n]:
                        alive[j[i == n]] = False
                rows += [k] * int(alive.sum())
                kept += [quads[n]["i"] for n in np.flatnonzero(alive).tolist()]
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(of) for c in range(len(keys) + 1)), pa.array(kept, b.schema.field(b.num_columns - 1).type.value_type.field("i").type)], [*keys, label, index])

    types = ", ".join(f"{k} {polygons.schema[k].dataType.simpleString()}" for k in [*keys, label, index])
    return pages.mapInArrow(run, types)


def logic_cells(cells: DataFrame, keys: list[str], votes: DataFrame, least: float = 0.3, size: tuple[int, int] = (1, 1)) -> DataFrame:
    """Cells above a score with rows and columns read off a grid of votes at their corners, from 0.

    ``cells``: keys, ``cell_idx, score`` and ``corners`` (eight numbers, in grid
    units); ``votes``: keys, ``grid_x, grid_y, col, row``.  A corner outside the
    grid is read at its edge; of the four votes the least starts and the greatest
    ends a cell.  Coordinates come out relative to ``size``.
    """
    kept = cells.filter(F.col("score") >= least)
    edge = votes.groupBy(*keys).agg(F.max("grid_x").alias("_mx"), F.max("grid_y").alias("_my"))
    corner = F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(F.element_at("corners", 2 * k + 1).alias("x"), F.element_at("corners", 2 * k + 2).alias("y"))))
    at = kept.join(edge, keys).select(*keys, "cell_idx", "_mx", "_my", corner.alias("c"))
    clamp = lambda v, most: F.least(F.greatest(F.floor(v), F.lit(0)), F.col(most)).cast("long")
    read = at.select(*keys, "cell_idx", clamp(F.col("c.x"), "_mx").alias("grid_x"), clamp(F.col("c.y"), "_my").alias("grid_y")).join(votes, [*keys, "grid_x", "grid_y"])
    whole = lambda f, c: F.greatest(F.bround(f(c)).cast("int") - 1, F.lit(0))
    logic = read.groupBy(*keys, "cell_idx").agg(whole(F.min, "row").alias("row_start"), whole(F.max, "row").alias("row_end"), whole(F.min, "col").alias("col_start"), whole(F.max, "col").alias("col_end"))
    relative = F.transform("corners", lambda v, i: F.least(F.greatest(v / F.when(i % 2 == 0, size[0]).otherwise(size[1]), F.lit(0.0)), F.lit(1.0)))
    return kept.select(*keys, "cell_idx", "score", relative.alias("corners")).join(logic, [*keys, "cell_idx"])


def relocated(corners: DataFrame, points: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """Cell corners snapped to the best detected corner within reach: the nearest, of equally near ones the surest.

    ``corners``: keys, ``cell_idx, corner_idx, x, y``; ``points``: keys, ``px, py, score``.  Points meet in squares of ``reach``.
    """
    square = lambda x, y: (F.floor(F.col(x) / reach), F.floor(F.col(y) / reach))
    cx, cy = square("x", "y")
    around = corners.withColumns({"_cx": F.explode(F.array(cx - 1, cx, cx + 1))}).withColumn("_cy", F.explode(F.array(cy - 1, cy, cy + 1)))
    px, py = square("px", "py")
    d = (F.col("px") - F.col("x")) * (F.col("px") - F.col("x")) + (F.col("py") - F.col("y")) * (F.col("py") - F.col("y"))
    near = around.join(points.withColumns({"_cx": px, "_cy": py}), [*keys, "_cx", "_cy"]).withColumn("_d", d).filter(F.col("_d") <= reach * reach)
    best = near.groupBy(*keys, "cell_idx", "corner_idx").agg(F.min(F.struct("_d", -F.col("score"), "px", "py")).alias("b"))
    out = corners.join(best, [*keys, "cell_idx", "corner_idx"], "left")
    return out.withColumns({"x": F.coalesce("b.px", "x"), "y": F.coalesce("b.py", "y")}).drop("b")


def top_queries(logits: DataFrame, keys: list[str], k: int = 300, least: float = 0.3) -> DataFrame:
    """Best ``k`` (query, class) pairs of a page by sigmoid score, those above the threshold.

    ``logits``: keys, ``query_idx``, and ``logits`` by class.
    """
    pairs = logits.select(*keys, "query_idx", F.posexplode("logits").alias("class_idx", "v")).withColumn("score", sigmoid(F.col("v")))
    best = Window.partitionBy(*keys).orderBy(F.desc("v"), "query_idx", "class_idx")
    return pairs.withColumn("_k", F.row_number().over(best)).filter((F.col("_k") <= k) & (F.col("score") > least)).drop("_k", "v")
