"""Document queries over typeset words, recognised words and pages, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ..operators import boxes as B
from ..operators import exporters as E
from ..operators import linear as N
from ..operators import lines as L
from ..operators import metrics as M
from ..operators import predict as P
from ..operators import reading as R
from ..operators.typeset import predicted_words, typeset_words
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
PAGE = ["doc_id", "page_idx"]
BOX = ("x0", "y0", "x1", "y1")

WORDS = r"""
t AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, unnest(range(len(l))) AS idx, unnest(l) AS value FROM t),
c AS (SELECT doc_id, idx, value, length(value) AS n, CAST(sum(length(value) + 1) OVER (PARTITION BY doc_id ORDER BY idx) AS BIGINT) - length(value) - 1 AS col FROM k),
w AS (SELECT doc_id, col // 80 // 40 AS page_idx, idx AS word_idx, value, 10 * (col % 80) AS x0, 25 * ((col // 80) % 40) + (idx * 7 + doc_id * 3) % 5 AS y0,
  least(10 * (col % 80) + 10 * n, 800) AS x1, 25 * ((col // 80) % 40) + (idx * 7 + doc_id * 3) % 5 + 18 AS y1, 50 + (idx * 11 + doc_id) % 50 AS confidence_pct FROM c)"""
PREDICTED = """,
p AS (SELECT doc_id, page_idx, word_idx, CASE WHEN word_idx % 4 = 1 THEN upper(replace(value, 'ß', 'SS')) WHEN word_idx % 4 = 3 THEN substr(value, 1, 3) ELSE value END AS value,
  x0 + (word_idx * 13 + doc_id) % 7 - 3 AS x0, y0, x1 + (word_idx * 13 + doc_id) % 7 - 3 AS x1, y1, confidence_pct FROM w WHERE (word_idx * 31 + doc_id * 17) % 20 <> 0)"""
PAIRS = """,
j AS (SELECT w.doc_id, w.page_idx, w.word_idx AS a, p.word_idx AS b, w.value AS truth, p.value AS predicted,
  (least(w.x1, p.x1) - greatest(w.x0, p.x0)) * (least(w.y1, p.y1) - greatest(w.y0, p.y0)) AS shared,
  (w.x1 - w.x0) * (w.y1 - w.y0) + (p.x1 - p.x0) * (p.y1 - p.y0) AS areas
  FROM w JOIN p ON w.doc_id = p.doc_id AND w.page_idx = p.page_idx AND w.y0 // 25 = p.y0 // 25 AND w.x0 < p.x1 AND p.x0 < w.x1 AND w.y0 < p.y1 AND p.y0 < w.y1),
i AS (SELECT *, CAST(shared AS DOUBLE) / (areas - shared) AS iou FROM j)"""
REGIONS = """,
r AS (SELECT doc_id, page_idx, CAST(region_idx AS BIGINT) AS region_idx, type, x0, y0, x1, y1 FROM (SELECT DISTINCT doc_id, page_idx FROM w) CROSS JOIN
  (VALUES (0, 'Title', 0, 0, 800, 50), (1, 'Text', 0, 50, 400, 800), (2, 'Text', 400, 50, 800, 800), (3, 'Table', 0, 800, 800, 1000)) AS v(region_idx, type, x0, y0, x1, y1))"""
CELLS = """,
g AS (SELECT doc_id, page_idx, CAST(0 AS BIGINT) AS table_idx, CAST(i AS BIGINT) AS cell_idx, CAST(i // 4 AS BIGINT) AS row_start, CAST(i % 4 AS BIGINT) AS col_start,
  200 * (i % 4) AS x0, 800 + 25 * (i // 4) AS y0, 200 * (i % 4) + 200 AS x1, 825 + 25 * (i // 4) AS y1 FROM (SELECT DISTINCT doc_id, page_idx FROM w) CROSS JOIN range(32) AS s(i))"""
#: Rows of a page: an ordered fold, as the Spark side does it.
ROWS = """,
o AS (SELECT doc_id, page_idx, list_sort(list({'k': x0 / 800 + 2 * (y1 / 1000) / (18.0::DOUBLE / 1000), 'i': word_idx, 'c': y0 + y1})) AS l FROM w GROUP BY ALL),
f AS (SELECT doc_id, page_idx, list_reduce(list_transform(l, lambda e: {'row': 0::BIGINT, 'n': 1::BIGINT, 't': e.c, 'out': [{'i': e.i, 'r': 0::BIGINT}]}), lambda a, e:
  CASE WHEN abs(e.t * a.n - a.t) < 18 * a.n THEN {'row': a.row, 'n': a.n + 1, 't': a.t + e.t, 'out': list_append(a.out, {'i': e.out[1].i, 'r': a.row})}
  ELSE {'row': a.row + 1, 'n': 1::BIGINT, 't': e.t, 'out': list_append(a.out, {'i': e.out[1].i, 'r': a.row + 1})} END).out AS out FROM o),
rw AS (SELECT doc_id, page_idx, u.i AS word_idx, u.r AS row_idx FROM (SELECT doc_id, page_idx, unnest(out) AS u FROM f))"""
LINES = ROWS + """,
gp AS (SELECT w.*, rw.row_idx, w.x0 - lag(w.x1) OVER (PARTITION BY w.doc_id, w.page_idx, rw.row_idx ORDER BY w.x0, w.word_idx) AS gap FROM w JOIN rw USING (doc_id, page_idx, word_idx)),
ln AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap >= 28 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_idx ORDER BY row_idx, x0, word_idx) AS BIGINT) - 1 AS line_idx FROM gp)"""


def query(sql: str | None = None, *parts: str):
    """Registers a query under its function's name, with SQL over the given common parts."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = ("WITH RECURSIVE " + "".join(parts).lstrip(",\n ") + "\n" if parts else "") + sql
        return f

    return keep


def words(spark: SparkSession, d: str) -> DataFrame:
    return typeset_words(table(spark, d, "documents"))


def regions(w: DataFrame) -> DataFrame:
    fixed = [(0, "Title", 0, 0, 800, 50), (1, "Text", 0, 50, 400, 800), (2, "Text", 400, 50, 800, 800), (3, "Table", 0, 800, 800, 1000)]
    r = F.array(*(F.struct(*(F.lit(v).cast("string" if isinstance(v, str) else "long").alias(n) for n, v in zip(("region_idx", "type", *BOX), x))) for x in fixed))
    return w.select(*PAGE).distinct().select(*PAGE, F.explode(r).alias("r")).select(*PAGE, "r.*")


def cells(w: DataFrame) -> DataFrame:
    i = F.col("i")
    out = w.select(*PAGE).distinct().select(*PAGE, F.explode(F.sequence(F.lit(0), F.lit(31))).alias("i"))
    row, col = F.floor(i / 4), i % 4
    return out.select(*PAGE, F.lit(0).cast("long").alias("table_idx"), i.cast("long").alias("cell_idx"), row.cast("long").alias("row_start"), col.cast("long").alias("col_start"), (200 * col).cast("long").alias("x0"), (800 + 25 * row).cast("long").alias("y0"), (200 * col + 200).cast("long").alias("x1"), (825 + 25 * row).cast("long").alias("y1"))


def matched(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d)
    a, b = B.box_of("a"), B.box_of("b")
    return B.overlap_pairs(w, predicted_words(w), PAGE).select("a.doc_id", "a.page_idx", F.col("a.word_idx").alias("a"), F.col("b.word_idx").alias("b"), F.col("a.value").alias("truth"), F.col("b.value").alias("predicted"), G.iou(a, b).alias("iou"))


@query("SELECT * FROM w", WORDS)
def words_typeset(spark, d):
    return words(spark, d)


@query("SELECT doc_id, page_idx, line_idx, string_agg(value, ' ' ORDER BY x0, word_idx) AS text, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n_words, sum(confidence_pct)::DOUBLE / count(*) AS confidence_pct FROM ln GROUP BY ALL", WORDS, LINES)
def resolve_lines(spark, d):
    return L.line_table(L.resolve_lines(words(spark, d)))


@query("SELECT doc_id, page_idx, word_idx, row_idx FROM rw", WORDS, ROWS)
def resolve_rows(spark, d):
    return L.resolve_rows(words(spark, d)).select(*PAGE, "word_idx", "row_idx")


@query("SELECT doc_id, page_idx, word_idx, line_idx FROM ln", WORDS, LINES)
def resolve_sub_lines(spark, d):
    return L.resolve_lines(words(spark, d)).select(*PAGE, "word_idx", "line_idx")


@query("SELECT doc_id, page_idx, word_idx, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY x0 + 2 * y1 / 18.0::DOUBLE, word_idx) AS rank FROM w", WORDS)
def sort_boxes(spark, d):
    return L.sorted_boxes(words(spark, d)).select(*PAGE, "word_idx", "rank")


@query("SELECT doc_id, page_idx, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n FROM w GROUP BY ALL", WORDS)
def bbox_enclosing_page(spark, d):
    return words(spark, d).groupBy(*PAGE).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT word_id, list_min(list_filter(geometry, lambda x, i: i % 2 = 1)) AS xmin, list_min(list_filter(geometry, lambda x, i: i % 2 = 0)) AS ymin, list_max(list_filter(geometry, lambda x, i: i % 2 = 1)) AS xmax, list_max(list_filter(geometry, lambda x, i: i % 2 = 0)) AS ymax FROM ocr_words WHERE len(geometry) IN (4, 8)")
def polygon_to_bbox(spark, d):
    w = table(spark, d, "ocr_words").filter(F.size("geometry").isin(4, 8))
    return w.select("word_id", *(v.alias(k) for k, v in G.flat_box(F.col("geometry")).items())).distinct()


@query("SELECT doc_id, page_idx, word_idx, x0::DOUBLE AS tl_x, y0::DOUBLE AS tl_y, x1::DOUBLE AS br_x, y1::DOUBLE AS br_y, ((x1 - x0) * (y1 - y0))::DOUBLE AS area FROM w", WORDS)
def order_points(spark, d):
    w = words(spark, d)
    p = G.ordered_points(G.box_corners(*(F.col(c) for c in BOX)))
    return w.select(*PAGE, "word_idx", p.alias("p")).select(*PAGE, "word_idx", F.col("p")[0]["x"].alias("tl_x"), F.col("p")[0]["y"].alias("tl_y"), F.col("p")[2]["x"].alias("br_x"), F.col("p")[2]["y"].alias("br_y"), G.polygon_area(F.col("p")).alias("area"))


@query("SELECT doc_id, page_idx, word_idx, round(((x0/800::DOUBLE - 0.5) * 800 * cos(radians(30.0)) - (0.5 - y0/1000::DOUBLE) * 1000 * sin(radians(30.0))) / 800 + 0.5, 6) AS x, round(0.5 - ((x0/800::DOUBLE - 0.5) * 800 * sin(radians(30.0)) + (0.5 - y0/1000::DOUBLE) * 1000 * cos(radians(30.0))) / 1000, 6) AS y FROM w", WORDS)
def rotate_boxes(spark, d):
    w = words(spark, d)
    p = G.rotate_box(F.col("x0") / 800, F.col("y0") / 1000, F.col("x1") / 800, F.col("y1") / 1000, 30.0, F.lit(1000.0), F.lit(800.0))[0]
    return w.select(*PAGE, "word_idx", F.round(p["x"], 6).alias("x"), F.round(p["y"], 6).alias("y"))


@query("SELECT doc_id, page_idx, word_idx, round((x0/800::DOUBLE * 800 + (1000 - 800) / 2.0::DOUBLE) / 1000, 9) AS x, round((y0/1000::DOUBLE * 1000 + (1200 - 1000) / 2.0::DOUBLE) / 1200, 9) AS y FROM w", WORDS)
def remap_boxes(spark, d):
    w = words(spark, d)
    return w.select(*PAGE, "word_idx", F.round(G.remap(F.col("x0") / 800, F.lit(800.0), F.lit(1000.0)), 9).alias("x"), F.round(G.remap(F.col("y0") / 1000, F.lit(1000.0), F.lit(1200.0)), 9).alias("y"))


@query("SELECT doc_id, page_idx, word_idx, round(least(greatest((x0/800::DOUBLE - 0.5) * (1000::DOUBLE/800) + 0.5, 0), 1), 9) AS x, y0/1000::DOUBLE AS y FROM w", WORDS)
def remove_padding(spark, d):
    w = words(spark, d)
    x, y = G.unpadded(F.col("x0") / 800, F.col("y0") / 1000, F.lit(1000.0), F.lit(800.0), True)
    return w.select(*PAGE, "word_idx", F.round(x, 9).alias("x"), y.alias("y"))


@query("SELECT doc_id, page_idx, word_idx, least(greatest(x0/800::DOUBLE, 0), 1) AS xmin, least(greatest(y0/1000::DOUBLE, 0), 1) AS ymin, least(greatest(x1/800::DOUBLE, 0), 1) AS xmax, least(greatest(y1/1000::DOUBLE, 0), 1) AS ymax FROM w", WORDS)
def to_relative_coords(spark, d):
    return words(spark, d).select(*PAGE, "word_idx", *(G.relative(F.col(c), F.lit(s)).alias(n) for c, s, n in (("x0", 800.0, "xmin"), ("y0", 1000.0, "ymin"), ("x1", 800.0, "xmax"), ("y1", 1000.0, "ymax"))))


@query("SELECT * FROM (SELECT doc_id, page_idx, word_idx, greatest(x0, 100) - 100 AS x0, greatest(y0, 100) - 100 AS y0, least(x1, 500) - 100 AS x1, least(y1, 700) - 100 AS y1 FROM w) WHERE x1 > x0 AND y1 > y0", WORDS)
def crop_boxes(spark, d):
    x0, x1 = G.crop(F.col("x0"), F.col("x1"), F.lit(100), F.lit(500))
    y0, y1 = G.crop(F.col("y0"), F.col("y1"), F.lit(100), F.lit(700))
    return words(spark, d).select(*PAGE, "word_idx", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")).filter("x1 > x0 and y1 > y0")


@query("SELECT doc_id, page_idx, word_idx, 800 - x1 AS x0, y0, 800 - x0 AS x1, y1 FROM w", WORDS)
def flip_boxes(spark, d):
    return words(spark, d).select(*PAGE, "word_idx", (800 - F.col("x1")).alias("x0"), "y0", (800 - F.col("x0")).alias("x1"), "y1")


@query("SELECT doc_id, page_idx, word_idx, CAST(round_even(x0/1000::DOUBLE * 640, 0) AS BIGINT) AS x0, CAST(round_even(x1/1000::DOUBLE * 640, 0) AS BIGINT) + 1 AS x1 FROM w", WORDS)
def crop_windows(spark, d):
    return words(spark, d).select(*PAGE, "word_idx", E.pixel(F.col("x0") / 1000, F.lit(640)).alias("x0"), (E.pixel(F.col("x1") / 1000, F.lit(640)) + 1).alias("x1"))


@query("SELECT doc_id, page_idx, round(median(a), 6) AS angle, count(a) AS n FROM (SELECT doc_id, page_idx, degrees(atan(((word_idx % 5) - 2) / (x1 - x0)::DOUBLE)) AS a FROM w) GROUP BY ALL", WORDS)
def page_angle_median(spark, d):
    x0, x1, y0, y1, t = (F.col(c) for c in ("x0", "x1", "y0", "y1", "t"))
    poly = F.array(G.point(x0, y0 + t), G.point(x1, y0), G.point(x1, y1), G.point(x0, y1 + t))
    a = words(spark, d).withColumn("t", F.col("word_idx") % 5 - 2).select(*PAGE, G.word_angle(poly).alias("a"))
    return a.groupBy(*PAGE).agg(F.round(F.percentile("a", F.lit(0.5)), 6).alias("angle"), F.count("a").alias("n"))


@query("SELECT doc_id, page_idx, word_idx, round(least((h+w-sqrt((h+w)*(h+w)-4*(w*h*(1-0.7)/(1+0.7))))/2, (2*(h+w)-sqrt(4*(h+w)*(h+w)-16*(1-0.7)*w*h))/8, (-2*0.7*(h+w)+sqrt(4*0.7*0.7*(h+w)*(h+w)-16*0.7*(0.7-1)*w*h))/(8*0.7)), 6) AS radius FROM (SELECT doc_id, page_idx, word_idx, (x1-x0)::DOUBLE AS w, (y1-y0)::DOUBLE AS h FROM w)", WORDS)
def gaussian_radius(spark, d):
    return words(spark, d).select(*PAGE, "word_idx", F.round(G.gaussian_radius((F.col("x1") - F.col("x0")).cast("double"), (F.col("y1") - F.col("y0")).cast("double")), 6).alias("radius"))


@query("SELECT doc_id, page_idx, word_idx, CAST((word_idx % 4) AS BIGINT) AS turns, (CASE word_idx % 4 WHEN 0 THEN x0 WHEN 1 THEN x1 WHEN 2 THEN x1 ELSE x0 END)::DOUBLE AS first_x, (CASE word_idx % 4 WHEN 0 THEN y0 WHEN 1 THEN y0 WHEN 2 THEN y1 ELSE y1 END)::DOUBLE AS first_y FROM w", WORDS)
def rectify_polygons(spark, d):
    p = G.shifted_vertices(G.box_polygon(*(F.col(c) for c in BOX)), (F.col("word_idx") % 4).cast("int"))[0]
    return words(spark, d).select(*PAGE, "word_idx", (F.col("word_idx") % 4).alias("turns"), p["x"].alias("first_x"), p["y"].alias("first_y"))


@query("SELECT doc_id, page_idx, a, b, iou FROM i", WORDS, PREDICTED, PAIRS)
def iou_pairs(spark, d):
    return matched(spark, d).select(*PAGE, "a", "b", "iou")


@query("SELECT doc_id, page_idx, b, arg_max(a, iou) AS a, max(iou) AS iou FROM i GROUP BY doc_id, page_idx, b", WORDS, PREDICTED, PAIRS)
def iou_best_match(spark, d):
    return matched(spark, d).groupBy(*PAGE, "b").agg(F.max_by("a", "iou").alias("a"), F.max("iou").alias("iou"))


@query("SELECT w.doc_id, w.page_idx, w.word_idx, arg_min(r.type, r.region_idx - 1000000.0 * cover) AS type FROM w LEFT JOIN (SELECT w.doc_id, w.page_idx, w.word_idx, r.region_idx, r.type, (least(w.x1, r.x1) - greatest(w.x0, r.x0)) * (least(w.y1, r.y1) - greatest(w.y0, r.y0)) / ((w.x1 - w.x0) * (w.y1 - w.y0))::DOUBLE AS cover FROM w JOIN r USING (doc_id, page_idx) WHERE w.x0 < r.x1 AND r.x0 < w.x1 AND w.y0 < r.y1 AND r.y0 < w.y1) r ON w.doc_id = r.doc_id AND w.page_idx = r.page_idx AND w.word_idx = r.word_idx AND r.cover >= 0.5 GROUP BY ALL", WORDS, REGIONS)
def coverage_label(spark, d):
    w = words(spark, d)
    return R.covering_labels(w, regions(w), PAGE, "word_idx").select(*PAGE, "word_idx", "type")


@query("SELECT w.doc_id, w.page_idx, w.word_idx FROM w WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.type = 'Table' AND r.doc_id = w.doc_id AND r.page_idx = w.page_idx AND (w.x0 + w.x1) / 2.0 >= r.x0 AND (w.x0 + w.x1) / 2.0 < r.x1 AND (w.y0 + w.y1) / 2.0 >= r.y0 AND (w.y0 + w.y1) / 2.0 < r.y1)", WORDS, REGIONS)
def region_mask_anti(spark, d):
    w = words(spark, d)
    r = regions(w).filter("type = 'Table'").alias("r")
    cx, cy = (F.col("w.x0") + F.col("w.x1")) / 2, (F.col("w.y0") + F.col("w.y1")) / 2
    on = [F.col("w.doc_id") == F.col("r.doc_id"), F.col("w.page_idx") == F.col("r.page_idx"), cx >= F.col("r.x0"), cx < F.col("r.x1"), cy >= F.col("r.y0"), cy < F.col("r.y1")]
    return w.alias("w").join(r, on, "left_anti").select(*PAGE, "word_idx")


@query("SELECT doc_id, page_idx, word_idx, ((x0 + x1) / 2.0 < 400 AND (y0 + y1) / 2.0 < 500.25 + 0.5 * (x0 + x1) / 2.0) AS inside FROM w", WORDS)
def point_in_polygon(spark, d):
    poly = F.array(*(G.point(F.lit(x), F.lit(y)) for x, y in ((-1.0, -1.0), (400.0, -1.0), (400.0, 700.25), (-1.0, 499.75))))
    return words(spark, d).select(*PAGE, "word_idx", G.in_polygon((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, poly).alias("inside"))


CONTAINED = """,
m AS (SELECT w.doc_id, w.page_idx, w.word_idx, w.value, w.x0, w.confidence_pct, (w.x0 + w.x1) / 2.0::DOUBLE AS cx, (w.y0 + w.y1) / 2.0::DOUBLE AS cy FROM w),
ca AS (SELECT m.doc_id, m.page_idx, m.word_idx, g.table_idx, g.cell_idx, (cx >= g.x0 AND cx < g.x1 AND cy >= g.y0 AND cy < g.y1) AS ins, sqrt((cx - (g.x0 + g.x1) / 2.0::DOUBLE) ** 2 + (cy - (g.y0 + g.y1) / 2.0::DOUBLE) ** 2) AS dist
  FROM m JOIN g ON m.doc_id = g.doc_id AND m.page_idx = g.page_idx WHERE cx BETWEEN 0 AND 800 AND cy BETWEEN 800 AND 1000),
cw AS (SELECT doc_id, page_idx, word_idx, min({'t': table_idx, 'r': CASE WHEN ins THEN 0 ELSE 1 END, 'c': CASE WHEN ins THEN cell_idx::DOUBLE ELSE dist END, 'i': cell_idx}) AS b FROM ca WHERE ins OR dist <= sqrt(200.0::DOUBLE * 200 + 25.0::DOUBLE * 25) / 2 GROUP BY ALL)"""


#: Words of a cell in rows: an ordered fold by centre, then each row from left to right.
FILLED = """,
cl AS (SELECT cw.doc_id, cw.page_idx, cw.b.i AS cell_idx, list_sort(list({'c': w.y0 + w.y1, 'x': w.x0 + w.x1, 'i': w.word_idx, 'v': w.value})) AS l, median(w.y1 - w.y0) AS height, avg(w.confidence_pct)::DOUBLE AS confidence_pct
  FROM cw JOIN w USING (doc_id, page_idx, word_idx) GROUP BY ALL),
cf AS (SELECT doc_id, page_idx, cell_idx, confidence_pct, height, list_reduce(list_transform(l, lambda e: {'row': 0::BIGINT, 'n': 1::BIGINT, 't': e.c, 'out': [{'r': 0::BIGINT, 'x': e.x, 'i': e.i, 'v': e.v}]}), lambda a, e:
  CASE WHEN e.t * a.n - a.t < 18 * a.n THEN {'row': a.row, 'n': a.n + 1, 't': a.t + e.t, 'out': list_append(a.out, {'r': a.row, 'x': e.out[1].x, 'i': e.out[1].i, 'v': e.out[1].v})}
  ELSE {'row': a.row + 1, 'n': 1::BIGINT, 't': e.t, 'out': list_append(a.out, {'r': a.row + 1, 'x': e.out[1].x, 'i': e.out[1].i, 'v': e.out[1].v})} END).out AS out FROM cl),
tc AS (SELECT g.doc_id, g.page_idx, g.cell_idx, g.row_start, g.col_start, coalesce(array_to_string(list_transform(list_sort(out), lambda e: e.v), ' '), '') AS value, confidence_pct FROM g LEFT JOIN cf USING (doc_id, page_idx, cell_idx))"""


@query("SELECT doc_id, page_idx, word_idx, b.t AS table_idx, b.i AS cell_idx FROM cw", WORDS, CELLS, CONTAINED)
def point_in_cell(spark, d):
    w = words(spark, d)
    return B.containing_cells(w, cells(w), PAGE).select(*PAGE, "word_idx", "table_idx", "cell_idx")


@query("SELECT doc_id, page_idx, word_idx FROM w ANTI JOIN cw USING (doc_id, page_idx, word_idx)", WORDS, CELLS, CONTAINED)
def consumed_words_anti(spark, d):
    w = words(spark, d)
    return w.join(B.containing_cells(w, cells(w), PAGE), [*PAGE, "word_idx"], "left_anti").select(*PAGE, "word_idx")


@query("SELECT doc_id, page_idx, cell_idx, value, confidence_pct FROM tc", WORDS, CELLS, CONTAINED, FILLED)
def table_cells_filled(spark, d):
    return filled_grid(spark, d).select(*PAGE, "cell_idx", "value", "confidence_pct")


def filled_grid(spark, d) -> DataFrame:
    w = words(spark, d)
    g = cells(w)
    text = B.cell_text(B.containing_cells(w, g, PAGE), PAGE).drop("n_words")
    grid = g.select(*PAGE, "table_idx", "cell_idx", "row_start", F.col("row_start").alias("row_end"), "col_start", F.col("col_start").alias("col_end"))
    return grid.join(text, [*PAGE, "table_idx", "cell_idx"], "left").withColumn("value", F.coalesce("value", F.lit("")))


GRID = """,
tr AS (SELECT doc_id, page_idx, row_start, string_agg(value, chr(9) ORDER BY col_start) AS line FROM tc GROUP BY ALL)"""


@query("SELECT doc_id, page_idx, string_agg(line, chr(10) ORDER BY row_start) AS text FROM tr GROUP BY ALL", WORDS, CELLS, CONTAINED, FILLED, GRID)
def table_grid_text(spark, d):
    return E.table_text(E.grid_rows(filled_grid(spark, d), PAGE), PAGE)


@query("SELECT doc_id, page_idx, string_agg(CASE WHEN row_start = 0 THEN line || chr(10) || '| --- | --- | --- | --- |' ELSE line END, chr(10) ORDER BY row_start) AS text FROM (SELECT doc_id, page_idx, row_start, '| ' || string_agg(regexp_replace(value, '([\\\\`*_\\[\\]|#<>])', '\\\\\\1', 'g'), ' | ' ORDER BY col_start) || ' |' AS line FROM tc GROUP BY ALL) GROUP BY ALL", WORDS, CELLS, CONTAINED, FILLED)
def table_markdown(spark, d):
    return E.table_text(E.grid_rows(filled_grid(spark, d), PAGE), PAGE, "md")


@query("SELECT doc_id, page_idx, '|===' || chr(10) || string_agg(CASE WHEN row_start = 0 THEN line || chr(10) ELSE line END, chr(10) ORDER BY row_start) || chr(10) || '|===' AS text FROM (SELECT doc_id, page_idx, row_start, string_agg('|' || regexp_replace(value, '([\\\\`*_#^~|+{}<>])', '\\\\\\1', 'g'), ' ' ORDER BY col_start) AS line FROM tc GROUP BY ALL) GROUP BY ALL", WORDS, CELLS, CONTAINED, FILLED)
def table_asciidoc(spark, d):
    return E.table_text(E.grid_rows(filled_grid(spark, d), PAGE), PAGE, "adoc")


@query("SELECT page_id, t - 1 AS table_idx, c - 1 AS cell_idx, cell.row_start - min(cell.row_start) OVER (PARTITION BY page_id, t) AS row_start, cell.col_start - min(cell.col_start) OVER (PARTITION BY page_id, t) AS col_start, CAST(max(cell.row_end) OVER (PARTITION BY page_id, t) - min(cell.row_start) OVER (PARTITION BY page_id, t) + 1 AS INT) AS n_rows FROM (SELECT page_id, t, unnest(range(1, len(tab.cells) + 1)) AS c, unnest(tab.cells) AS cell FROM (SELECT page_id, unnest(range(1, len(tables) + 1)) AS t, unnest(tables) AS tab FROM (SELECT page_id, arg_min(tables, received_at) AS tables FROM ocr_pages GROUP BY page_id)))")
def table_localize_logic(spark, d):
    p = table(spark, d, "ocr_pages").filter("tables is not null").groupBy("page_id").agg(F.min_by("tables", "received_at").alias("tables"))
    t = p.select("page_id", F.posexplode("tables").alias("table_idx", "t")).select("page_id", F.col("table_idx").cast("long").alias("table_idx"), F.posexplode("t.cells").alias("cell_idx", "c"))
    w = Window.partitionBy("page_id", "table_idx")
    top, left = F.min("c.row_start").over(w), F.min("c.col_start").over(w)
    return t.select("page_id", "table_idx", F.col("cell_idx").cast("long").alias("cell_idx"), (F.col("c.row_start") - top).alias("row_start"), (F.col("c.col_start") - left).alias("col_start"), (F.max("c.row_end").over(w) - top + 1).cast("int").alias("n_rows"))


@query(None)
def text_match(spark, d):
    """Four levels over all pairs; no SQL, as lower case differs between engines at a final sigma (tests/test_whole.py has the brute force)."""
    return M.text_match(matched(spark, d))


@query("SELECT lang, source, count(*) AS n, (count(*) FILTER (truth = predicted))::DOUBLE / count(*) AS raw FROM i JOIN documents USING (doc_id) GROUP BY ROLLUP (lang, source)", WORDS, PREDICTED, PAIRS)
def text_match_by_lang_rollup(spark, d):
    m = matched(spark, d).join(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id")
    return m.rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"), (F.count_if(F.col("truth") == F.col("predicted")) / F.count(F.lit(1))).alias("raw"))


@query("SELECT (SELECT count(*) FROM i WHERE iou >= 0.5)::DOUBLE / (SELECT count(*) FROM w) AS recall, (SELECT count(*) FROM i WHERE iou >= 0.5)::DOUBLE / (SELECT count(*) FROM p) AS precision, round_even((SELECT sum(m) FROM (SELECT max(iou) AS m FROM i GROUP BY doc_id, page_idx, b)) / (SELECT count(*) FROM p), 2) AS mean_iou, (SELECT count(*) FROM i WHERE iou >= 0.5 AND truth = predicted)::DOUBLE / (SELECT count(*) FROM w) AS equal_recall, (SELECT count(*) FROM i WHERE iou >= 0.5 AND truth = predicted)::DOUBLE / (SELECT count(*) FROM p) AS equal_precision", WORDS, PREDICTED, PAIRS)
def ocr_metric(spark, d):
    w = words(spark, d)
    m = M.page_matches(w, predicted_words(w), PAGE, {"equal": lambda: F.col("value")})
    return M.localisation(m)


@query(None)
def ocr_metric_levels(spark, d):
    """At all four levels."""
    w = words(spark, d)
    return M.ocr_metric(w, predicted_words(w), PAGE)


@query("SELECT (SELECT count(*) FROM i WHERE iou >= 0.5 AND a % 5 = b % 4)::DOUBLE / (SELECT count(*) FROM w) AS recall, (SELECT count(*) FROM i WHERE iou >= 0.5 AND a % 5 = b % 4)::DOUBLE / (SELECT count(*) FROM p) AS precision, round_even((SELECT sum(m) FROM (SELECT max(iou) AS m FROM i GROUP BY doc_id, page_idx, b)) / (SELECT count(*) FROM p), 2) AS mean_iou", WORDS, PREDICTED, PAIRS)
def detection_metric(spark, d):
    w = words(spark, d)
    return M.detection_metric(w.withColumn("class", F.col("word_idx") % 5), predicted_words(w).withColumn("class", F.col("word_idx") % 4), PAGE, "class")


@query("SELECT (count(*) FILTER (iou >= 0.5))::DOUBLE / (SELECT count(*) FROM g) AS recall, (count(*) FILTER (iou >= 0.5))::DOUBLE / (SELECT count(*) FROM q) AS precision, 2 * (count(*) FILTER (iou >= 0.5))::DOUBLE / ((SELECT count(*) FROM g) + (SELECT count(*) FROM q)) AS f1, (count(*) FILTER (iou >= 0.5 AND col_start = c2))::DOUBLE / (count(*) FILTER (iou >= 0.5)) AS structure_accuracy FROM (SELECT g.col_start, q.col_start AS c2, (least(g.x1, q.x1) - greatest(g.x0, q.x0)) * 25 / (2 * 5000.0::DOUBLE - (least(g.x1, q.x1) - greatest(g.x0, q.x0)) * 25) AS iou FROM g JOIN q USING (doc_id, page_idx, cell_idx))", WORDS, CELLS, """,
q AS (SELECT doc_id, page_idx, cell_idx, row_start, col_start + CASE WHEN cell_idx % 7 = 3 THEN 1 ELSE 0 END AS col_start, x0 + cell_idx * 4 AS x0, y0, x1 + cell_idx * 4 AS x1, y1 FROM g WHERE cell_idx % 6 <> 5)""")
def cell_metric(spark, d):
    """Cells against a shifted copy without some, a few of them in a wrong column."""
    g = cells(words(spark, d)).withColumns({"row_end": F.col("row_start"), "col_end": F.col("col_start")})
    q = g.filter("cell_idx % 6 <> 5").withColumn("col_start", F.col("col_start") + (F.col("cell_idx") % 7 == 3).cast("int"))
    q = q.withColumns({c: F.col(c) + F.col("cell_idx") * 4 for c in ("x0", "x1")})
    return M.cell_metric(g, q, PAGE)


@query("SELECT doc_id, page_idx, a, b FROM i WHERE iou >= 0.5", WORDS, PREDICTED, PAIRS)
def localization_pairs(spark, d):
    return M.mutual_best(matched(spark, d), "a", "b", PAGE).filter("iou >= 0.5").select(*PAGE, "a", "b")


AP = """,
dt AS (SELECT CAST(b % 3 AS BIGINT) AS class, confidence_pct AS score, i.doc_id * 100000 + b AS ord, i.doc_id * 100000 + a AS truth_id, iou FROM i JOIN p ON i.doc_id = p.doc_id AND i.page_idx = p.page_idx AND i.b = p.word_idx),
gt AS (SELECT CAST(word_idx % 3 AS BIGINT) AS class, count(*) AS n FROM w GROUP BY ALL),
th AS (SELECT unnest([0.5, 0.75, 0.95])::DOUBLE AS threshold),
tp AS (SELECT class, threshold, score, ord, CASE WHEN iou >= threshold AND row_number() OVER (PARTITION BY class, threshold, truth_id, iou >= threshold ORDER BY score DESC, ord) = 1 THEN 1 ELSE 0 END AS tp FROM dt CROSS JOIN th),
cu AS (SELECT tp.class, threshold, sum(tp) OVER q / n::DOUBLE AS recall, sum(tp) OVER q / (count(*) OVER q)::DOUBLE AS prec FROM tp JOIN gt ON tp.class = gt.class WINDOW q AS (PARTITION BY tp.class, threshold ORDER BY score DESC, ord ROWS UNBOUNDED PRECEDING)),
lv AS (SELECT class, threshold, floor(recall * 100) AS l, max(prec) AS p FROM cu GROUP BY ALL)"""


@query("SELECT class, threshold, round(sum(coalesce((SELECT max(c.p) FROM lv2 c WHERE c.class = x.class AND c.threshold = x.threshold AND c.k >= x.k), 0)) / 101, 6) AS ap FROM x GROUP BY ALL", WORDS, PREDICTED, PAIRS, AP, """,
lv2 AS (SELECT class, threshold, k, max(prec) AS p FROM (SELECT class, threshold, prec, CASE WHEN recall >= (floor(recall * 100) + 1) * 0.01::DOUBLE THEN floor(recall * 100) + 1 WHEN recall >= floor(recall * 100) * 0.01::DOUBLE THEN floor(recall * 100) ELSE floor(recall * 100) - 1 END AS k FROM cu) GROUP BY ALL),
x AS (SELECT class, threshold, k FROM gt CROSS JOIN th CROSS JOIN range(101) AS s(k))""")
def average_precision(spark, d):
    det, truth = detections(spark, d)
    return M.average_precision(det, truth, "class", [0.5, 0.75, 0.95]).withColumn("ap", F.round("ap", 6))


def detections(spark, d) -> tuple[DataFrame, DataFrame]:
    """Predicted words with their best truth, and the truths, in three classes."""
    w = words(spark, d)
    p = predicted_words(w).withColumn("score", F.col("confidence_pct"))
    a, b = B.box_of("a"), B.box_of("b")
    pairs = B.overlap_pairs(w, p, PAGE).select(F.col("b.doc_id").alias("doc_id"), F.col("a.word_idx").alias("a"), F.col("b.word_idx").alias("b"), F.col("b.score").alias("score"), G.iou(a, b).alias("iou"))
    number = lambda c: F.col("doc_id") * 100000 + F.col(c)
    return pairs.select((F.col("b") % 3).alias("class"), "score", number("b").alias("order"), number("a").alias("truth_id"), "iou"), w.select((F.col("word_idx") % 3).alias("class"))


@query("SELECT round(avg(ap), 6) AS map, round(max(CASE WHEN threshold = 0.5 THEN ap END), 6) AS map_50, round(max(CASE WHEN threshold = 0.75 THEN ap END), 6) AS map_75 FROM (SELECT threshold, avg(ap) AS ap FROM (SELECT class, threshold, sum(coalesce((SELECT max(c.p) FROM lv2 c WHERE c.class = x.class AND c.threshold = x.threshold AND c.k >= x.k), 0)) / 101 AS ap FROM x GROUP BY ALL) GROUP BY threshold)", WORDS, PREDICTED, PAIRS, AP.replace("[0.5, 0.75, 0.95]", "[0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]"), """,
lv2 AS (SELECT class, threshold, k, max(prec) AS p FROM (SELECT class, threshold, prec, CASE WHEN recall >= (floor(recall * 100) + 1) * 0.01::DOUBLE THEN floor(recall * 100) + 1 WHEN recall >= floor(recall * 100) * 0.01::DOUBLE THEN floor(recall * 100) ELSE floor(recall * 100) - 1 END AS k FROM cu) GROUP BY ALL),
x AS (SELECT class, threshold, k FROM gt CROSS JOIN th CROSS JOIN range(101) AS s(k))""")
def detection_summary(spark, d):
    """Mean average precision over ten thresholds."""
    det, truth = detections(spark, d)
    out = M.detection_summary(det, truth, "class")
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns))


@query("SELECT page_id, block_idx, line_idx, count(*) AS n, round(avg(objectness_score), 9) AS objectness FROM (SELECT DISTINCT word_id, page_id, block_idx, line_idx, objectness_score FROM ocr_words) GROUP BY ALL")
def line_objectness(spark, d):
    w = table(spark, d, "ocr_words").select("word_id", "page_id", "block_idx", "line_idx", "objectness_score").distinct()
    return w.groupBy("page_id", "block_idx", "line_idx").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("objectness_score"), 9).alias("objectness"))


@query("SELECT page_id, block_idx, count(*) AS n, round(avg(objectness_score), 9) AS objectness FROM (SELECT DISTINCT word_id, page_id, block_idx, objectness_score FROM ocr_words) GROUP BY ALL")
def block_objectness(spark, d):
    w = table(spark, d, "ocr_words").select("word_id", "page_id", "block_idx", "objectness_score").distinct()
    return w.groupBy("page_id", "block_idx").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("objectness_score"), 9).alias("objectness"))


@query("SELECT DISTINCT r.type AS type, lower(regexp_replace(trim(r.type), '[^a-zA-Z0-9]', '_', 'g')) AS label, CASE lower(regexp_replace(trim(r.type), '[^a-zA-Z0-9]', '_', 'g')) WHEN 'page_header' THEN 'header' WHEN 'page_footer' THEN 'footer' WHEN 'footnote' THEN 'footnote' WHEN 'caption' THEN 'caption' WHEN 'table' THEN 'float' WHEN 'picture' THEN 'float' WHEN 'formula' THEN 'float' WHEN 'figure' THEN 'float' ELSE 'body' END AS role FROM (SELECT unnest(layout) AS r FROM ocr_pages) WHERE r.type IS NOT NULL")
def label_role(spark, d):
    r = table(spark, d, "ocr_pages").select(F.explode("layout").alias("r")).select("r.type").filter("type is not null").distinct()
    return r.select("type", X.normal_label(F.col("type")).alias("label"), X.label_role(F.col("type")).alias("role"))


#: Greedy suppression: boxes from the best score down, each against those kept so far.
SCORED = """,
sl AS (SELECT doc_id, page_idx, list_sort(list({'k': -confidence_pct, 'i': -word_idx, 'x0': x0 - word_idx % 40 * 4, 'y0': y0, 'x1': x1, 'y1': y1})) AS l FROM w GROUP BY ALL),
sk AS (SELECT doc_id, page_idx, list_reduce(list_transform(l, lambda e: [e]), lambda a, e: CASE WHEN len(list_filter(a, lambda k: greatest(least(k.x1, e[1].x1) - greatest(k.x0, e[1].x0), 0) * greatest(least(k.y1, e[1].y1) - greatest(k.y0, e[1].y0), 0)
  > 0.2::DOUBLE * ((k.x1 - k.x0) * (k.y1 - k.y0) + (e[1].x1 - e[1].x0) * (e[1].y1 - e[1].y0) - greatest(least(k.x1, e[1].x1) - greatest(k.x0, e[1].x0), 0) * greatest(least(k.y1, e[1].y1) - greatest(k.y0, e[1].y0), 0)))) > 0 THEN a ELSE list_append(a, e[1]) END) AS kept FROM sl)"""


@query("SELECT doc_id, page_idx, -k.i AS word_idx FROM (SELECT doc_id, page_idx, unnest(kept) AS k FROM sk)", WORDS, SCORED)
def nms_greedy(spark, d):
    w = words(spark, d).withColumn("x0", F.col("x0") - F.col("word_idx") % 40 * 4)
    return B.nms(w, PAGE, "word_idx", "confidence_pct", 0.2)


@query("SELECT doc_id, word_idx, confidence_pct FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence_pct DESC, word_idx) AS k FROM w) WHERE k <= 5", WORDS)
def topk_scores(spark, d):
    k = Window.partitionBy("doc_id").orderBy(F.desc("confidence_pct"), "word_idx")
    return words(spark, d).withColumn("k", F.row_number().over(k)).filter("k <= 5").select("doc_id", "word_idx", "confidence_pct")


@query("SELECT doc_id, word_idx, list_distinct(list_append(range(0, greatest(n * 30 - 60, 0) + 1, 30), greatest(n * 30 - 60, 0))).list_sort() AS starts FROM (SELECT doc_id, idx AS word_idx, n FROM c)", WORDS)
def split_windows(spark, d):
    n = F.char_length("value").cast("long")
    return words(spark, d).select("doc_id", "word_idx", F.sort_array(G.window_starts(n * 30, F.lit(60), F.lit(30))).alias("starts"))


VOCAB = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


@query(f"SELECT doc_id, word_idx, list_transform(regexp_extract_all(value, '.'), lambda c: CAST(instr('{VOCAB}', c) - 1 AS INT)) AS codes FROM w WHERE regexp_full_match(value, '[A-Za-z0-9]+')", WORDS)
def vocab_encode(spark, d):
    w = words(spark, d).filter(F.col("value").rlike("^[A-Za-z0-9]+$"))
    return w.select("doc_id", "word_idx", X.encoded(F.col("value"), VOCAB).alias("codes"))


@query("SELECT doc_id, word_idx, value AS decoded FROM w WHERE regexp_full_match(value, '[A-Za-z0-9]+')", WORDS)
def vocab_decode(spark, d):
    return vocab_encode(spark, d).select("doc_id", "word_idx", X.decoded(F.col("codes"), VOCAB).alias("decoded"))


@query(f"SELECT doc_id, word_idx, list_concat(list_transform(regexp_extract_all(value, '.'), lambda c: CAST(instr('{VOCAB}', c) - 1 AS INT)), [62::INT], list_transform(range(width - length(value) - 1), lambda x: 63::INT)) AS codes FROM w, (SELECT max(length(value)) + 2 AS width FROM w WHERE regexp_full_match(value, '[A-Za-z0-9]+')) WHERE regexp_full_match(value, '[A-Za-z0-9]+')", WORDS)
def encode_padded(spark, d):
    codes = vocab_encode(spark, d)
    width = codes.agg((F.max(F.size("codes")) + 2).alias("width"))  # the longest word, its end mark and one pad
    return codes.crossJoin(F.broadcast(width)).select("doc_id", "word_idx", X.padded(F.col("codes"), F.col("width"), 62, 63).alias("codes"))


@query(f"SELECT doc_id, word_idx, regexp_replace(translate(regexp_replace(value, '[\\s\\v\\x{{85}}\\p{{Z}}\\x{{1c}}-\\x{{1f}}]', '', 'g'), '{X.accents()[0]}', '{X.accents()[1]}'), '[^{VOCAB}.,''-]', '■', 'g') AS value FROM w", WORDS)
def vocab_translate(spark, d):
    return words(spark, d).select("doc_id", "word_idx", X.to_vocabulary(F.col("value"), VOCAB + ".,-'").alias("value"))


ESCAPED = """,
es AS (SELECT doc_id, word_idx, value, regexp_replace(value, '([\\\\`*_\\[\\]|#<>])', '\\\\\\1', 'g') AS md, regexp_replace(value, '([\\\\`*_#^~|+{}<>])', '\\\\\\1', 'g') AS adoc FROM w)"""


@query("SELECT doc_id, word_idx, CASE WHEN regexp_matches(md, '^\\s*([-+>#=`]|[\\p{Nd}²³¹⁰⁴-⁹₀-₉]+\\.*( |$))') THEN '\\' || md ELSE md END AS md, CASE WHEN regexp_matches(adoc, '^\\s*[=*.\\-/+]') THEN '{empty}' || adoc ELSE adoc END AS adoc, replace(replace(replace(value, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS html FROM es", WORDS, ESCAPED)
def markup_escape(spark, d):
    v = F.col("value")
    return words(spark, d).select("doc_id", "word_idx", X.markdown_line(X.markdown_escaped(v)).alias("md"), X.asciidoc_line(X.asciidoc_escaped(v)).alias("adoc"), X.html_escaped(v).alias("html"))


@query("SELECT doc_id, CASE WHEN r > l - r OR (r = l - r AND coalesce(lang IN ('ar', 'fa', 'he', 'ur', 'yi'), false)) THEN 'rtl' ELSE 'ltr' END AS direction FROM (SELECT doc_id, lang, length(regexp_replace(coalesce(text, ''), '[^\\p{Hebrew}\\p{Arabic}\\p{Syriac}\\p{Thaana}\\p{Nko}]|[^\\p{L}]', '', 'g')) AS r, length(regexp_replace(coalesce(text, ''), '[^\\p{L}]', '', 'g')) AS l FROM documents)")
def text_direction(spark, d):
    return table(spark, d, "documents").select("doc_id", X.text_direction(F.col("text"), F.col("lang")).alias("direction"))


@query(None)
def merge_strings(spark, d):
    n = F.char_length("value")
    w = words(spark, d).filter(n >= 8)
    parts = F.array(F.substring("value", 1, 5), F.expr("substring(value, 3, 5)"), F.expr("substring(value, 5)"))
    return w.select("doc_id", "word_idx", X.merged(parts, F.lit(0.6), F.lit(0.4)).alias("value"))


@query("SELECT doc_id, word_idx, value AS text FROM w", WORDS)
def ctc_decode(spark, d):
    """Every word from logits over its own characters: some steps repeat theirs, a blank parts doubled letters."""
    chars, symbols = F.col("chars"), F.col("symbols")
    w = words(spark, d).select("doc_id", "word_idx", X.characters(F.col("value")).alias("chars"))
    w = w.withColumn("symbols", F.concat(F.array(F.lit("")), F.array_distinct(chars)))
    parted = lambda c, i: (i > 0) & (c == F.element_at(chars, F.greatest(i, F.lit(1))))
    path = F.flatten(F.transform(chars, lambda c, i: F.concat(F.when(parted(c, i), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")), F.array_repeat(c, i % 2 + 1))))
    step = lambda c, i: F.transform(symbols, lambda s, k: F.when(s == c, 5.0).otherwise((i * 3 + k * 7) % 5 / 2))
    w = w.withColumn("steps", F.transform(F.concat(path, F.array(F.lit(""))), step))
    return w.select("doc_id", "word_idx", X.ctc_decode(F.col("steps"), symbols, 0)[0].alias("text"))


def items(spark, d) -> DataFrame:
    """Two lines an item, its label by its place: every kind of item comes up."""
    t = L.line_table(L.resolve_lines(words(spark, d)))
    k = F.floor(F.col("line_idx") / 2)
    rows = t.groupBy(*PAGE, k.alias("position")).agg(F.transform(F.sort_array(F.collect_list(F.struct("line_idx", "text"))), lambda s: s["text"]).alias("lines"))
    k = F.col("position")
    label = F.when(k == 0, "Title").when(k % 13 == 6, "Page-footer").when(k % 11 == 5, "Section-header").when(k % 7 >= 5, "List-item").when(k % 5 == 4, "Footnote").when(k % 3 == 1, "Text")
    return rows.withColumn("label", label)


ITEMS = LINES + """,
lt AS (SELECT doc_id, page_idx, line_idx, string_agg(value, ' ' ORDER BY x0, word_idx) AS text FROM ln GROUP BY ALL),
ik AS (SELECT doc_id, page_idx, line_idx // 2 AS position, list(text ORDER BY line_idx) AS lines FROM lt GROUP BY ALL),
il AS (SELECT *, CASE WHEN position = 0 THEN 'Title' WHEN position % 13 = 6 THEN 'Page-footer' WHEN position % 11 = 5 THEN 'Section-header' WHEN position % 7 >= 5 THEN 'List-item' WHEN position % 5 = 4 THEN 'Footnote' WHEN position % 3 = 1 THEN 'Text' END AS label FROM ik)"""
#: Items of one format, runs of list entries numbered, and pages of them.
MARKUP = {
    "text": ("lambda t: t", "lambda t: t", "array_to_string(m, chr(10))", "array_to_string(m, chr(10))", "", ""),
    "markdown": ("lambda t: regexp_replace(t, '([\\\\`*_\\[\\]|#<>])', '\\\\\\1', 'g')", "lambda t: CASE WHEN regexp_matches(t, '^\\s*([-+>#=`]|[\\p{Nd}²³¹⁰⁴-⁹₀-₉]+\\.*( |$))') THEN '\\' || t ELSE t END", "'# ' || array_to_string(e, ' ')", "'## ' || array_to_string(e, ' ')", "'- '", ""),
    "asciidoc": ("lambda t: regexp_replace(t, '([\\\\`*_#^~|+{}<>])', '\\\\\\1', 'g')", "lambda t: CASE WHEN regexp_matches(t, '^\\s*[=*.\\-/+]') THEN '{empty}' || t ELSE t END", "'== ' || array_to_string(e, ' ')", "'=== ' || array_to_string(e, ' ')", "'* '", ""),
}


def page_sql(form: str) -> str:
    escape, finish, title, section, bullet, _ = MARKUP[form]
    bullet = bullet or "''"
    return f""",
ie AS (SELECT *, list_transform(lines, {escape}) AS e FROM il),
im AS (SELECT *, list_transform(e, {finish}) AS m, list_transform([array_to_string(e, ' ')], {finish})[1] AS one FROM ie),
io AS (SELECT doc_id, page_idx, position, CASE label WHEN 'Title' THEN {title} WHEN 'Section-header' THEN {section} WHEN 'List-item' THEN {bullet} || one ELSE array_to_string(m, chr(10)) END AS t,
  CASE WHEN label = 'List-item' AND lag(label) OVER (PARTITION BY doc_id, page_idx ORDER BY position) = 'List-item' THEN 0 ELSE 1 END AS fresh FROM im),
ig AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page_idx ORDER BY position) AS g FROM io),
ir AS (SELECT doc_id, page_idx, g, string_agg(t, chr(10) ORDER BY position) AS t FROM ig GROUP BY ALL),
pt AS (SELECT doc_id, page_idx, string_agg(t, chr(10) || chr(10) ORDER BY g) AS text FROM ir GROUP BY ALL)"""


@query("SELECT doc_id, page_idx, text FROM pt", WORDS, ITEMS, page_sql("text"))
def page_text(spark, d):
    return E.page_text(items(spark, d), PAGE)


HTML = """,
ie AS (SELECT *, list_transform(lines, lambda t: replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS e FROM il WHERE coalesce(label, '') NOT IN ('Page-footer', 'Footnote')),
io AS (SELECT doc_id, page_idx, position, coalesce(label, '') = 'List-item' AS l, CASE label WHEN 'Title' THEN '<h1>' || array_to_string(e, ' ') || '</h1>' WHEN 'Section-header' THEN '<h2>' || array_to_string(e, ' ') || '</h2>' WHEN 'List-item' THEN '<li>' || array_to_string(e, ' ') || '</li>' ELSE '<p>' || array_to_string(e, '<br>' || chr(10)) || '</p>' END AS t FROM ie),
ig AS (SELECT *, sum(CASE WHEN l AND lag(l) OVER q THEN 0 ELSE 1 END) OVER q AS g FROM (SELECT * FROM io) WINDOW q AS (PARTITION BY doc_id, page_idx ORDER BY position)),
ir AS (SELECT doc_id, page_idx, g, CASE WHEN any_value(l) THEN '<ul>' || chr(10) || string_agg(t, chr(10) ORDER BY position) || chr(10) || '</ul>' ELSE string_agg(t, chr(10) ORDER BY position) END AS t FROM ig GROUP BY ALL)"""


@query("SELECT doc_id, page_idx, string_agg(t, chr(10) ORDER BY g) AS text FROM ir GROUP BY ALL", WORDS, ITEMS, HTML.replace("sum(CASE WHEN l AND lag(l) OVER q THEN 0 ELSE 1 END) OVER q AS g FROM (SELECT * FROM io)", "sum(f) OVER q AS g FROM (SELECT *, CASE WHEN l AND lag(l) OVER (PARTITION BY doc_id, page_idx ORDER BY position) THEN 0 ELSE 1 END AS f FROM io)"))
def page_html(spark, d):
    """Without furniture."""
    return E.page_text(items(spark, d), PAGE, "html", furniture=False)


@query("SELECT doc_id, page_idx, text FROM pt", WORDS, ITEMS, page_sql("markdown"))
def page_markdown(spark, d):
    return E.page_text(items(spark, d), PAGE, "markdown")


@query("SELECT doc_id, page_idx, text FROM pt", WORDS, ITEMS, page_sql("asciidoc"))
def page_asciidoc(spark, d):
    return E.export_as("adoc", PAGE, items(spark, d))


@query("SELECT doc_id, string_agg(text, chr(10) || chr(10) || chr(10) || chr(10) ORDER BY page_idx) AS text FROM pt GROUP BY doc_id", WORDS, ITEMS, page_sql("text"))
def document_text(spark, d):
    return E.document_text(page_text(spark, d), "doc_id", "page_idx")


@query("SELECT doc_id, string_agg(text, chr(10) || chr(10) || '<<<' || chr(10) || chr(10) ORDER BY page_idx) AS text FROM pt GROUP BY doc_id", WORDS, ITEMS, page_sql("asciidoc"))
def document_asciidoc(spark, d):
    return E.documents_as("adoc", E.page_text(items(spark, d), PAGE, "asciidoc"), "doc_id", "page_idx")


HOCR_HEAD = '<head><title>hOCR export</title><meta http-equiv="Content-Type" content="text/html; charset=utf-8" /><meta name="ocr-system" content="paperloom" /><meta name="ocr-capabilities" content="ocr_page ocr_carea ocr_par ocr_line ocrx_word" /></head>'
HOCR = """,
hw AS (SELECT *, line_idx // 3 AS block_idx FROM ln),
h1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY block_idx, line_idx, word_idx) AS wn FROM hw),
h2 AS (SELECT doc_id, page_idx, block_idx, line_idx, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, string_agg('<span class="ocrx_word" id="word_' || wn || '" title="bbox ' || x0 || ' ' || y0 || ' ' || x1 || ' ' || y1 || '; x_wconf ' || confidence_pct || '">' || replace(replace(replace(value, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</span>', '' ORDER BY wn) AS t FROM h1 GROUP BY ALL),
h3 AS (SELECT doc_id, page_idx, block_idx, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, string_agg('<span class="ocr_line" id="line_' || (line_idx + 1) || '" title="bbox ' || x0 || ' ' || y0 || ' ' || x1 || ' ' || y1 || '; baseline 0 0; x_size ' || (y1 - y0) || '; x_fsize ' || (y1 - y0) || '; x_descenders 0; x_ascenders 0">' || t || '</span>', '' ORDER BY line_idx) AS t FROM h2 GROUP BY ALL),
h4 AS (SELECT doc_id, page_idx, string_agg('<div class="ocr_carea" id="block_' || (block_idx + 1) || '" title="bbox ' || x0 || ' ' || y0 || ' ' || x1 || ' ' || y1 || '"><p class="ocr_par" id="par_' || (block_idx + 1) || '" title="bbox ' || x0 || ' ' || y0 || ' ' || x1 || ' ' || y1 || '">' || t || '</p></div>', '' ORDER BY block_idx) AS t FROM h3 GROUP BY ALL)"""


@query(f"SELECT doc_id, page_idx, '<html xmlns=\"http://www.w3.org/1999/xhtml\" xml:lang=\"en\">{HOCR_HEAD}<body><div class=\"ocr_page\" id=\"page_' || (page_idx + 1) || '\" title=\"image; bbox 0 0 800 1000; ppageno 0\">' || t || '</div></body></html>' AS hocr FROM h4", WORDS, LINES, HOCR)
def page_hocr(spark, d):
    """Three lines a block; boxes relative to the page, as recognisers give them."""
    w = L.resolve_lines(words(spark, d)).withColumn("block_idx", F.floor(F.col("line_idx") / 3))
    w = w.withColumns({c: F.col(c) / s for c, s in zip(BOX, (800, 1000, 800, 1000))} | {"confidence": F.col("confidence_pct") / 100})
    return E.export_as("hocr", PAGE, words=w, width=800, height=1000)


@query("SELECT doc_id, page_idx, to_json({'lines': list({'words': words} ORDER BY line_idx)})::VARCHAR AS json FROM (SELECT doc_id, page_idx, line_idx, list({'word_idx': word_idx, 'value': value, 'geometry': [x0, y0, x1, y1]} ORDER BY word_idx) AS words FROM ln GROUP BY ALL) GROUP BY ALL", WORDS, LINES)
def page_json(spark, d):
    return E.export_as("json", PAGE, words=L.resolve_lines(words(spark, d)))


def linear_lines(spark, d) -> DataFrame:
    w = L.resolve_lines(words(spark, d))
    edges = (f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1")))
    return w.groupBy(*PAGE, "line_idx").agg(F.sort_array(F.collect_list(F.struct("x0", "word_idx", "value", "y0", "x1", "y1"))).alias("words"), *edges)


@query(None)
def page_items(spark, d):
    """Every page as ordered items of labelled lines."""
    lines = linear_lines(spark, d)
    return N.page_items(lines, PAGE, regions(words(spark, d))).drop("elements")


@query(None)
def page_exported(spark, d):
    """Pages linearised and written as Markdown."""
    return E.export_as("md", PAGE, N.page_items(linear_lines(spark, d), PAGE, regions(words(spark, d))))


@query("SELECT doc_id, page_idx, class_idx, word_idx, value FROM fl JOIN w USING (doc_id, page_idx, word_idx, value)", WORDS, """,
fl AS (SELECT doc_id, page_idx, word_idx % 9 AS class_idx, word_idx, value FROM w WHERE word_idx % 9 < 3)""")
def kie_predictions(spark, d):
    """Key information in the order of its classes and of reading.

    Texts are shared out by document before they become words: every later step stays in its partition.
    """
    w = typeset_words(table(spark, d, "documents").repartition("doc_id")).filter("word_idx % 9 < 3").withColumn("class_idx", F.col("word_idx") % 9)
    return N.ordered_predictions(w.select(*PAGE, "class_idx", "word_idx", "value", *BOX), PAGE).select(*PAGE, "class_idx", "word_idx", "value")


@query("SELECT doc_id, page_idx, word_idx, CASE WHEN (x1 - x0) * 1000 >= 2 * 800 THEN 0.0 ELSE x0 - y0 * (x1 - x0) / 2.0::DOUBLE END AS x0, CASE WHEN (x1 - x0) * 1000 >= 2 * 800 THEN y0 - x0 * 2.0::DOUBLE / (x1 - x0) ELSE 0.0 END AS y0 FROM w", WORDS)
def expand_line(spark, d):
    ends = G.expanded_line(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y0") + 2, F.lit(800), F.lit(1000))
    return words(spark, d).select(*PAGE, "word_idx", ends["x0"].alias("x0"), ends["y0"].alias("y0"))


@query("SELECT doc_id, page_idx, a, b, round(iou, 6) AS iou FROM i", WORDS, PREDICTED, PAIRS)
def polygon_iou(spark, d):
    """Quads of overlapping words, clipped against each other."""
    w = words(spark, d)
    quad = lambda t: F.flatten(F.transform(G.box_polygon(*B.box_of(t)), lambda p: F.array(p["x"], p["y"])))
    pairs = B.overlap_pairs(w, predicted_words(w), PAGE)
    return pairs.select("a.doc_id", "a.page_idx", F.col("a.word_idx").alias("a"), F.col("b.word_idx").alias("b"), F.round(B.polygon_iou_column()(quad("a"), quad("b")), 6).alias("iou"))


@query("SELECT w.doc_id, w.word_idx, CASE WHEN least(w.x1 - w.x0, p.x1 - p.x0) > 0 THEN greatest(least(w.x1, p.x1) - greatest(w.x0, p.x0), 0)::DOUBLE / least(w.x1 - w.x0, p.x1 - p.x0) ELSE 0.0 END AS ratio FROM w JOIN p USING (doc_id, page_idx, word_idx)", WORDS, PREDICTED)
def overlap_ratio(spark, d):
    w = words(spark, d)
    p = predicted_words(w).select(*PAGE, "word_idx", F.col("x0").alias("p0"), F.col("x1").alias("p1"))
    return w.join(p, [*PAGE, "word_idx"]).select("doc_id", "word_idx", G.overlap_ratio(F.col("x0"), F.col("x1"), F.col("p0"), F.col("p1")).alias("ratio"))


@query("SELECT doc_id, page_idx, word_idx, round((y1 - y0) * cos(radians(30.0)) + (x1 - x0) * sin(radians(30.0)), 6) AS h, round((y1 - y0) * sin(radians(30.0)) + (x1 - x0) * cos(radians(30.0)), 6) AS w FROM w", WORDS)
def expanded_shape(spark, d):
    h, w = G.expanded_shape((F.col("y1") - F.col("y0")).cast("double"), (F.col("x1") - F.col("x0")).cast("double"), 30.0)
    return words(spark, d).select(*PAGE, "word_idx", F.round(h, 6).alias("h"), F.round(w, 6).alias("w"))


@query("SELECT doc_id, page_idx, word_idx, round((x0 + x1) / 2.0::DOUBLE + (-(x1 - x0) * 0.8::DOUBLE + (y1 - y0) * 0.6::DOUBLE) / 2, 6) AS x, round((y0 + y1) / 2.0::DOUBLE + (-(x1 - x0) * 0.6::DOUBLE - (y1 - y0) * 0.8::DOUBLE) / 2, 6) AS y FROM w", WORDS)
def oriented_corners(spark, d):
    """First corner of a box whose sine and cosine are not normalised."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in BOX)
    first = G.oriented_box((x0 + x1) / 2, (y0 + y1) / 2, x1 - x0, y1 - y0, F.lit(1.2), F.lit(1.6))[0]
    return words(spark, d).select(*PAGE, "word_idx", F.round(first["x"], 6).alias("x"), F.round(first["y"], 6).alias("y"))


@query("SELECT doc_id, page_idx, query_idx, class_idx, round(1 / (1 + exp(-v)), 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY v DESC, query_idx, class_idx) AS k FROM (SELECT doc_id, page_idx, word_idx AS query_idx, 0 AS class_idx, (confidence_pct - 75) / 10::DOUBLE AS v FROM w UNION ALL SELECT doc_id, page_idx, word_idx, 1, (word_idx % 7 - 3)::DOUBLE FROM w)) WHERE k <= 20 AND 1 / (1 + exp(-v)) > 0.3", WORDS)
def top_queries(spark, d):
    w = words(spark, d).withColumnRenamed("word_idx", "query_idx")
    logits = w.select(*PAGE, "query_idx", F.array((F.col("confidence_pct") - 75) / 10, (F.col("query_idx") % 7 - 3).cast("double")).alias("logits"))
    return B.top_queries(logits, PAGE, 20).select(*PAGE, "query_idx", "class_idx", F.round("score", 6).alias("score"))


@query("SELECT doc_id, page_idx, word_idx, round(least(greatest(x0 + 0.1::DOUBLE * y0 + 5, 0), 799) / 800, 9) AS x, round(least(greatest(y0 + 3::DOUBLE, 0), 999) / 1000, 9) AS y FROM w", WORDS)
def to_original_coords(spark, d):
    """Points under the inverse map of a straightened page."""
    m = [[F.lit(v) for v in r] for r in ((1.0, 0.1, 5.0), (0.0, 1.0, 3.0), (0.0, 0.0, 1.0))]
    x, y = G.affine(F.col("x0"), F.col("y0"), m, F.lit(800.0), F.lit(1000.0))
    return words(spark, d).select(*PAGE, "word_idx", F.round(x, 9).alias("x"), F.round(y, 9).alias("y"))


@query("SELECT doc_id, page_idx, word_idx, round((x0 - 400) * cos(radians(5.0)) - (y0 - 500) * sin(radians(5.0)) + 400, 6) AS x, round((x0 - 400) * sin(radians(5.0)) + (y0 - 500) * cos(radians(5.0)) + 500, 6) AS y FROM w", WORDS)
def deskewed(spark, d):
    p = G.upright(G.box_polygon(*(F.col(c) for c in BOX)), F.lit(5.0), G.point(F.lit(400.0), F.lit(500.0)))[0]
    return words(spark, d).select(*PAGE, "word_idx", F.round(p["x"], 6).alias("x"), F.round(p["y"], 6).alias("y"))


@query("SELECT page_id, t - 1 AS table_idx, c - 1 AS cell_idx, cell.row_end - cell.row_start + 1 AS row_span, cell.col_end - cell.col_start + 1 AS col_span FROM (SELECT page_id, t, unnest(range(1, len(tab.cells) + 1)) AS c, unnest(tab.cells) AS cell FROM (SELECT page_id, unnest(range(1, len(tables) + 1)) AS t, unnest(tables) AS tab FROM (SELECT page_id, arg_min(tables, received_at) AS tables FROM ocr_pages GROUP BY page_id)))")
def cell_spans(spark, d):
    p = table(spark, d, "ocr_pages").filter("tables is not null").groupBy("page_id").agg(F.min_by("tables", "received_at").alias("tables"))
    t = p.select("page_id", F.posexplode("tables").alias("table_idx", "t")).select("page_id", F.col("table_idx").cast("long").alias("table_idx"), F.posexplode("t.cells").alias("cell_idx", "c"))
    return t.select("page_id", "table_idx", F.col("cell_idx").cast("long").alias("cell_idx"), (F.col("c.row_end") - F.col("c.row_start") + 1).alias("row_span"), (F.col("c.col_end") - F.col("c.col_start") + 1).alias("col_span"))


@query("SELECT doc_id, word_idx, value AS text FROM w WHERE regexp_full_match(value, '[A-Za-z0-9]+')", WORDS)
def attention_decode(spark, d):
    """Every plain word from logits over its own characters, an end mark and what follows it."""
    w = words(spark, d).filter(F.col("value").rlike("^[A-Za-z0-9]+$")).select("doc_id", "word_idx", X.characters(F.col("value")).alias("chars"))
    w = w.withColumn("symbols", F.array_distinct("chars"))
    end = F.size("symbols")
    codes = F.concat(F.transform("chars", lambda c: F.array_position("symbols", c).cast("int") - 1), F.array(end, F.lit(0)))
    steps = F.transform(codes, lambda c: F.transform(F.sequence(F.lit(0), end), lambda k: F.when(k == c, 5.0).otherwise((k * 7) % 5 / 2)))
    return w.withColumn("steps", steps).select("doc_id", "word_idx", X.attention_decode(F.col("steps"), F.col("symbols"), end, True)[0].alias("text"))


@query("SELECT doc_id, word_idx, arg_max(c, {'s': s, 'c': c}) AS char, max(s) AS score FROM (SELECT doc_id, word_idx, unnest(['a', 'é', 'x', 'e']) AS c, unnest([word_idx * 7 % 10, word_idx * 3 % 10, 9, doc_id % 10]) AS s FROM w) WHERE c IN ('a', 'e') GROUP BY ALL", WORDS)
def whitelist(spark, d):
    c = F.explode(F.array(*(F.struct(F.lit(ch).alias("char"), v.alias("score")) for ch, v in zip("aéxe", (F.col("word_idx") * 7 % 10, F.col("word_idx") * 3 % 10, F.lit(9).cast("long"), F.col("doc_id") % 10)))))
    cand = words(spark, d).select("doc_id", "word_idx", c.alias("c")).select("doc_id", "word_idx", "c.*")
    return P.restricted(cand, "aéxe", "ae", ["doc_id", "word_idx"])


def fields(spark, d) -> DataFrame:
    """Key information stand-in: the words of three classes of a document's page."""
    w = words(spark, d).filter("word_idx % 9 < 3")
    return w.select(*PAGE, (F.col("word_idx") % 9).alias("class_idx"), F.element_at(F.array(*map(F.lit, ("total", "date*", "name <1>"))), (F.col("word_idx") % 9 + 1).cast("int")).alias("class_name"), F.col("word_idx").alias("position"), "value")


FIELDS = """,
fl AS (SELECT doc_id, page_idx, word_idx % 9 AS class_idx, ['total', 'date*', 'name <1>'][word_idx % 9 + 1] AS class_name, word_idx AS position, value FROM w WHERE word_idx % 9 < 3),
fs AS (SELECT doc_id, page_idx, class_idx, class_name, string_agg('- ' || CASE WHEN regexp_matches(v, '^\\s*([-+>#=`]|[\\p{Nd}²³¹⁰⁴-⁹₀-₉]+\\.*( |$))') THEN '\\' || v ELSE v END, chr(10) ORDER BY position) AS t FROM (SELECT *, regexp_replace(value, '([\\\\`*_\\[\\]|#<>])', '\\\\\\1', 'g') AS v FROM fl) GROUP BY ALL)"""


@query("SELECT doc_id, page_idx, string_agg('**' || regexp_replace(class_name, '([\\\\`*_\\[\\]|#<>])', '\\\\\\1', 'g') || '**' || chr(10) || chr(10) || t, chr(10) || chr(10) ORDER BY class_idx) AS text FROM fs GROUP BY ALL", WORDS, FIELDS)
def kie_markdown(spark, d):
    return E.export_as("markdown", PAGE, predictions=fields(spark, d))


@query("SELECT doc_id, page_idx, string_agg('<h3>' || replace(replace(class_name, '<', '&lt;'), '>', '&gt;') || '</h3>' || chr(10) || '<ul>' || chr(10) || t || chr(10) || '</ul>', chr(10) ORDER BY class_idx) AS text FROM (SELECT doc_id, page_idx, class_idx, class_name, string_agg('<li>' || replace(replace(replace(value, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</li>', chr(10) ORDER BY position) AS t FROM fl GROUP BY ALL) GROUP BY ALL", WORDS, FIELDS)
def kie_html(spark, d):
    return E.export_as("html", PAGE, predictions=fields(spark, d))


#: Single linkage: the components of the graph of near lines, named by their first line.
BLOCKS = """,
bl AS (SELECT doc_id, page_idx, line_idx, min(x0) / 800::DOUBLE AS x0, min(y0) / 1000::DOUBLE AS y0, max(x1) / 800::DOUBLE AS x1, max(y1) / 1000::DOUBLE AS y1 FROM ln GROUP BY ALL),
bf AS (SELECT doc_id, page_idx, line_idx, [(x0 + y1) / 2, (y0 + x1) / 2, (x0 + x1) / 2, (y0 + y1) / 2, x0, y0] AS f FROM bl),
bn AS (SELECT a.doc_id, a.page_idx, a.line_idx AS u, b.line_idx AS v FROM bf a JOIN bf b ON a.doc_id = b.doc_id AND a.page_idx = b.page_idx WHERE list_distance(a.f, b.f) <= 0.1),
br AS (SELECT doc_id, page_idx, u, u AS root FROM bn WHERE u = v UNION SELECT bn.doc_id, bn.page_idx, bn.v AS u, br.root FROM br JOIN bn ON bn.doc_id = br.doc_id AND bn.page_idx = br.page_idx AND bn.u = br.u),
bm AS (SELECT doc_id, page_idx, u AS line_idx, min(root) AS root FROM br GROUP BY ALL)"""


@query("SELECT doc_id, page_idx, line_idx, dense_rank() OVER (PARTITION BY doc_id, page_idx ORDER BY root) - 1 AS block_idx FROM bm", WORDS, LINES, BLOCKS)
def resolve_blocks(spark, d):
    return L.resolve_blocks(L.line_table(L.resolve_lines(words(spark, d))), PAGE)


@query(None)
def reading_order(spark, d):
    return R.page_reading_order(L.line_table(L.resolve_lines(words(spark, d))), PAGE)


LABELLED = """,
sb AS (SELECT doc_id, page_idx, line_idx, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM ln GROUP BY ALL),
sv AS (SELECT sb.doc_id, sb.page_idx, sb.line_idx, arg_min(r.type, r.region_idx - 1000000.0 * cover) AS type FROM (SELECT sb.*, r.region_idx, r.type, (least(sb.x1, r.x1) - greatest(sb.x0, r.x0)) * (least(sb.y1, r.y1) - greatest(sb.y0, r.y0)) / ((sb.x1 - sb.x0) * (sb.y1 - sb.y0))::DOUBLE AS cover FROM sb JOIN r ON sb.doc_id = r.doc_id AND sb.page_idx = r.page_idx AND sb.x0 < r.x1 AND r.x0 < sb.x1 AND sb.y0 < r.y1 AND r.y0 < sb.y1) r JOIN sb USING (doc_id, page_idx, line_idx) WHERE cover >= 0.5 GROUP BY ALL),
sl AS (SELECT sb.*, coalesce(lower(sv.type), '') AS label FROM sb LEFT JOIN sv USING (doc_id, page_idx, line_idx))"""


@query("SELECT doc_id, page_idx, line_idx, CAST(sum(j) OVER (PARTITION BY doc_id, page_idx ORDER BY line_idx) AS BIGINT) - 1 AS segment_idx FROM (SELECT doc_id, page_idx, line_idx, CASE WHEN label = lag(label) OVER q AND label <> 'table' AND least(lag(x1) OVER q, x1) - greatest(lag(x0) OVER q, x0) > 0.2 * least(lag(x1) OVER q - lag(x0) OVER q, x1 - x0) AND y0 - lag(y1) OVER q <= 0.8 * median(y1 - y0) OVER (PARTITION BY doc_id, page_idx) THEN 0 ELSE 1 END AS j FROM sl WINDOW q AS (PARTITION BY doc_id, page_idx ORDER BY line_idx))", WORDS, LINES, REGIONS, LABELLED)
def reading_segments(spark, d):
    """Lines in segments of one label, floats apart."""
    w = words(spark, d)
    t = R.covering_labels(L.line_table(L.resolve_lines(w)).drop("text"), regions(w), PAGE, "line_idx")
    return R.reading_segments(t, PAGE, "line_idx", label="type").select(*PAGE, "line_idx", "segment_idx")


@query("SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, len(embedding) AS n FROM embeddings")
def embedding_norms(spark, d):
    e = table(spark, d, "embeddings")
    square = F.aggregate(F.transform("embedding", lambda v: v.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return e.select("vec_id", F.round(F.sqrt(square), 6).alias("norm"), F.size("embedding").cast("long").alias("n"))


@query("SELECT id, arg_max(vec_id, {'c': cosine, 'v': -vec_id}) AS vec_id, max(cosine) AS cosine FROM (SELECT a.vec_id AS id, b.vec_id, round(list_dot_product(a.v, b.v) / (a.n * b.n), 6) AS cosine FROM (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings) b, (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings WHERE vec_id % 50 = 0) a WHERE a.vec_id <> b.vec_id) GROUP BY id")
def embedding_nearest_weight(spark, d):
    """Nearest other vector, by cosine, of each vector whose id is divisible by 50, against all."""
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    e = e.withColumn("v", F.transform("v", lambda x: x / norm(F.col("v"))))
    asked = e.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("id"), F.col("v").alias("q"))
    dot = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return e.join(asked, F.col("vec_id") != F.col("id")).select("id", "vec_id", F.round(dot, 6).alias("cosine")).groupBy("id").agg(F.max_by("vec_id", F.struct("cosine", -F.col("vec_id"))).alias("vec_id"), F.max("cosine").alias("cosine"))
