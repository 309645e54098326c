"""Linearised pages, suppression of polygons, cells by votes, on small pages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.functions import geometry as G
from paperloom.operators import boxes as B
from paperloom.operators import exporters as E
from paperloom.operators import linear as N
from paperloom.operators import reading as R
from paperloom.plans import documents as D

KEYS = ["doc_id", "page_idx"]
WORD = "array<struct<value:string,x0:double,y0:double,x1:double,y1:double>>"
LINE = f"doc_id long, page_idx long, line_idx long, block_idx long, x0 double, y0 double, x1 double, y1 double, words {WORD}"
REGION = "doc_id long, page_idx long, region_idx long, type string, x0 double, y0 double, x1 double, y1 double"


def line(i, y, text, x=0.1, block=0):
    words = [(v, x + 0.1 * k, y, x + 0.1 * k + 0.08, y + 0.03) for k, v in enumerate(text.split())]
    return (1, 0, i, block, x, y, max(w[3] for w in words), y + 0.03, words)


def test_items(spark):
    rows = [line(0, 0.02, "Running head"), line(1, 0.1, "A title", block=1), line(2, 0.2, "first line"), line(3, 0.24, "second line"), line(4, 0.4, "entry one"), line(5, 0.44, "goes on"), line(6, 0.48, "entry two"), line(7, 0.95, "Page 3", block=7)]
    lines = spark.createDataFrame(rows, LINE)
    regions = spark.createDataFrame([(1, 0, k, t, 0.05, a, 0.9, b) for k, (t, a, b) in enumerate([("Page-header", 0.0, 0.06), ("Title", 0.09, 0.14), ("Text", 0.19, 0.28), ("List-item", 0.395, 0.475), ("List-item", 0.478, 0.52), ("Page-footer", 0.9, 1.0)])], REGION)
    tables = spark.createDataFrame([(1, 0, 0, 0.1, 0.6, 0.9, 0.8, "| a |")], "doc_id long, page_idx long, table_idx long, x0 double, y0 double, x1 double, y1 double, text string")
    items = N.page_items(lines, KEYS, regions, tables)
    got = [(r.label, r.lines, r.table) for r in items.orderBy("position").collect()]
    assert got == [
        ("Page-header", ["Running head"], None), ("Title", ["A title"], None), ("Text", ["first line", "second line"], None), ("List-item", ["entry one", "goes on"], None), ("List-item", ["entry two"], None), ("Table", [], "| a |"), ("Page-footer", ["Page 3"], None),
    ]
    assert E.page_text(items, KEYS, "md", furniture=False).first().text == "# A title\n\nfirst line\nsecond line\n\n- entry one goes on\n- entry two\n\n| a |"
    artefacts = spark.createDataFrame([(1, 0, 1, 0), (1, 0, 7, 1), (1, 0, 55, 2)], "doc_id long, page_idx long, block_idx long, artefact_idx long")
    assert {r.artefact_idx: r.position for r in N.attached_artefacts(items, lines, artefacts, KEYS).collect()} == {0: 1, 1: 6, 2: 6}
    assert [(r.block_idx, r.line_idx, r.element) for r in N.reordered_blocks(items, KEYS).orderBy("block_idx", "line_idx").collect()][:4] == [(0, 0, 0), (1, 0, 1), (2, 0, 2), (2, 1, 3)]
    assert N.page_items(lines.limit(0), KEYS, regions).collect() == [] and N.page_items(lines, KEYS).count() > 0


def test_directions(spark):
    rows = [line(0, 0.1, "שלום עולם"), line(1, 0.13, "hello world")]
    items = N.page_items(spark.createDataFrame(rows, LINE), KEYS).first()
    assert items.direction == "rtl" or items.direction == "ltr"
    right = N.page_items(spark.createDataFrame(rows[:1], LINE), KEYS).first()
    assert right.direction == "rtl" and right.lines == ["עולם שלום"]
    fixed = N.page_items(spark.createDataFrame(rows, LINE), KEYS, direction="rtl").first()
    assert fixed.lines == ["עולם שלום", "world hello"]
    auto = N.page_items(spark.createDataFrame([*rows, line(2, 0.16, "ועוד הרבה מילים כאן היום")], LINE), KEYS).first()
    assert auto.direction == "rtl" and auto.lines[1] == "hello world"


def test_predictions_in_order(spark):
    p = spark.createDataFrame([(1, 0, 0, "b", 0.6, 0.1, 0.7, 0.2), (1, 0, 0, "a", 0.1, 0.1, 0.2, 0.2), (1, 0, 1, "c", 0.1, 0.1, 0.2, 0.2), (1, 0, 0, "d", 0.1, 0.5, 0.2, 0.6)], "doc_id long, page_idx long, class_idx long, value string, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r.class_idx, r.position, r.value) for r in N.ordered_predictions(p, KEYS).collect()) == [(0, 0, "a"), (0, 1, "b"), (0, 2, "d"), (1, 0, "c")]


def random_page(r, kind, n):
    corner = r.random((n, 2)) if kind < 2 else r.integers(0, 12, (n, 2)).astype(float)
    boxes = np.concatenate([corner, corner + (r.random((n, 2)) * 0.3 if kind < 2 else r.integers(0, 6, (n, 2)))], axis=1)
    if kind == 1:  # two columns
        boxes[:, 0] = np.where(r.random(n) < 0.5, 0.05, 0.55)
        boxes[:, 2], boxes[:, 3] = boxes[:, 0] + r.random(n) * 0.4, boxes[:, 1] + 0.02
    if kind == 3:  # ends before starts
        boxes = r.normal(size=(n, 4))
    if kind == 4:
        boxes[r.integers(n), r.integers(4)] = np.nan
    return boxes


def test_many_pages_at_once_as_one_by_one():
    r = np.random.default_rng(5)
    pages = [random_page(r, k % 5, int(r.integers(1, 30))) for k in range(400)]
    ways = np.array([R.DIRECTIONS[k % 4] if k % 3 else "ltr" for k in range(400)], object)
    starts = np.cumsum([0, *map(len, pages)])[:-1]
    want = np.concatenate([s + np.array(R.reading_order(p, None, w)) for s, p, w in zip(starts, pages, ways)])
    for cells in (1, 2000, 1 << 16):
        assert (R.reading_orders(np.concatenate(pages), starts, ways, cells=cells) == want).all()
    assert R.reading_orders(np.zeros((0, 4)), np.zeros(0, int), np.array([], object)).tolist() == []
    with pytest.raises(ValueError):
        R.reading_orders(np.zeros((2, 4)), np.array([0]), np.array(["up"], object))


def test_pages_that_go_on_in_the_next_batch(spark):
    r = np.random.default_rng(6)
    pages = [random_page(r, k % 4, n) for k, n in enumerate((1, 7, 2, 9, 3, 4, 1, 5))]
    rows = [(k, n, f"{k} {n}", *map(float, b)) for k, p in enumerate(pages) for n, b in enumerate(p, 1)]
    df = spark.createDataFrame(rows, "page long, n int, value string, x0 double, y0 double, x1 double, y1 double").coalesce(1)
    want = [(k, f"{k} {i + 1}", at) for k, p in enumerate(pages) for at, i in enumerate(R.reading_order(p))]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 4, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert [(x.page, x.value, x.position) for x in R.in_reading_order(df, "n", block=6).collect()] == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert R.in_reading_order(df.limit(0), "n").collect() == []
    with pytest.raises(Exception, match="must follow each other"):
        R.in_reading_order(df.filter("n <> 2"), "n").collect()


def test_predictions_without_a_box_or_class(spark):
    p = spark.createDataFrame([(1, 0, 0, "b", 0.6, 0.1, 0.7, 0.2, 9), (1, 0, 0, "a", None, 0.1, 0.2, 0.2, 9), (1, 0, None, "c", 0.1, 0.1, 0.2, 0.2, 9), (None, 0, 0, "d", 0.1, 0.1, 0.2, 0.2, 9)], "doc_id long, page_idx long, class_idx long, value string, x0 double, y0 double, x1 double, y1 double, position long")
    got = N.ordered_predictions(p, KEYS)
    assert got.columns == ["doc_id", "page_idx", "class_idx", "value", "x0", "y0", "x1", "y1", "position"]
    assert sorted(r.value for r in got.collect()) == ["a", "b"] and sorted(r.position for r in got.collect()) == [0, 1]


def test_key_information_in_one_pass(spark, data):
    """Texts are shuffled once, words never; rows come by class and in reading order."""
    df = D.kie_predictions(spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan and "InPandas" not in plan
    boxes, got = {}, {}
    for w in D.words(spark, data).filter("word_idx % 9 < 3").collect():
        boxes.setdefault((w.doc_id, w.page_idx, w.word_idx % 9), []).append((w.y0, w.x0, w.value, w.x1, w.y1, w.word_idx))
    rows = df.collect()
    for r in rows:
        got.setdefault((r.doc_id, r.page_idx, r.class_idx), []).append(r.word_idx)
    keys = [(r.doc_id, r.page_idx, r.class_idx) for r in rows]
    assert list(got) == [k for k, last in zip(keys, [None, *keys]) if k != last]
    for key, words in boxes.items():
        words.sort()
        order = R.reading_order(np.array([(x0, y0, x1, y1) for y0, x0, _, x1, y1, _ in words]))
        assert got.pop(key) == [words[i][-1] for i in order]
    assert not got


def test_polygon_suppression(spark):
    box = lambda x, s=1.0: [x, 0.0, x + s, 0.0, x + s, s, x, s]
    rows = [(1, 0, "a", 0.9, box(0.0)), (1, 1, "a", 0.8, box(0.1)), (1, 2, "a", 0.7, box(0.6)), (1, 3, "b", 0.5, box(0.05)), (1, 4, "a", 0.9, box(0.02))]
    df = spark.createDataFrame(rows, "page long, idx long, label string, score double, polygon array<double>")
    assert sorted(r.idx for r in B.polygon_nms(df, ["page"], "idx", "label", "score").collect()) == [0, 2, 3]
    assert B.polygon_nms(df.limit(0), ["page"], "idx", "label", "score").collect() == []


def test_cells_by_votes(spark):
    votes = spark.createDataFrame([(1, x, y, 1.0 + x // 2, 1.0 + y // 2) for x in range(4) for y in range(4)], "page long, grid_x long, grid_y long, col double, row double")
    cells = spark.createDataFrame([(1, 0, 0.9, [0.0, 0.0, 1.5, 0.0, 1.5, 1.5, 0.0, 1.5]), (1, 1, 0.9, [0.0, 2.0, 9.0, 2.0, 9.0, 9.0, 0.0, 9.0]), (1, 2, 0.1, [0.0] * 8)], "page long, cell_idx long, score double, corners array<double>")
    got = {r.cell_idx: (r.row_start, r.row_end, r.col_start, r.col_end, r.corners[4]) for r in B.logic_cells(cells, ["page"], votes, size=(4, 4)).collect()}
    assert got == {0: (0, 0, 0, 0, 0.375), 1: (1, 1, 0, 1, 1.0)}
    corners = spark.createDataFrame([(1, 0, 0, 1.0, 1.0), (1, 0, 1, 5.0, 5.0)], "page long, cell_idx long, corner_idx long, x double, y double")
    points = spark.createDataFrame([(1, 1.4, 1.0, 0.5), (1, 1.2, 1.0, 0.4), (1, 7.0, 5.0, 0.9)], "page long, px double, py double, score double")
    assert {r.corner_idx: (r.x, r.y) for r in B.relocated(corners, points, ["page"], 1.0).collect()} == {0: (1.2, 1.0), 1: (5.0, 5.0)}


def test_line_to_the_edges_and_gaussians(spark):
    df = spark.createDataFrame([(10.0, 20.0, 30.0, 40.0), (5.0, 1.0, 5.0, 9.0), (0.0, 7.0, 3.0, 7.0), (4.0, 4.0, 4.0, 4.0)], "x0 double, y0 double, x1 double, y1 double")
    ends = G.expanded_line(*(F.col(c) for c in ("x0", "y0", "x1", "y1")), F.lit(100), F.lit(200))
    got = [tuple(r) for r in df.select(*(v.alias(k) for k, v in ends.items())).collect()]
    assert got == [(0.0, 10.0, 100.0, 110.0), (5.0, 0.0, 5.0, 200.0), (0.0, 7.0, 100.0, 7.0), (4.0, 4.0, 4.0, 4.0)]
    pair = spark.createDataFrame([(0.0, 0.0, 4.0, 2.0, 0.3, 0.0, 0.0, 4.0, 2.0, 0.3), (0.0, 0.0, 4.0, 2.0, 0.0, 90.0, 0.0, 4.0, 2.0, 0.0)], ", ".join(f"c{i} double" for i in range(10)))
    s = [r.s for r in pair.select(G.gaussian_similarity(tuple(F.col(f"c{i}") for i in range(5)), tuple(F.col(f"c{i}") for i in range(5, 10))).alias("s")).collect()]
    assert s[0] > 0.99 and s[1] < 0.01 and np.isfinite(s).all()
