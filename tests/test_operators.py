"""Joins, suppression, reading order, metrics and exports on small pages."""

import itertools
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.operators import boxes as B
from paperloom.operators import exporters as E
from paperloom.operators import lines as L
from paperloom.operators import metrics as M
from paperloom.operators.predict import read_pages, regroup, whitelisted
from paperloom.operators.reading import canonical, covering_labels, gutter, reading_order, reading_segments

BOX = "doc_id long, page_idx long, idx long, x0 double, y0 double, x1 double, y1 double"


def test_nms_and_grid(spark):
    rows = [(1, 0, 0, 0.0, 0.0, 1.0, 1.0, 0.9), (1, 0, 1, 0.1, 0.1, 1.0, 1.0, 0.8), (1, 0, 2, 2.0, 2.0, 3.0, 3.0, 0.7), (1, 0, 3, 2.0, 2.0, 3.0, 2.9, 0.6)]
    df = spark.createDataFrame(rows, BOX + ", score double")
    assert sorted(r.idx for r in B.nms(df, ["doc_id", "page_idx"], "idx", "score", 0.2).collect()) == [0, 2]
    rng = np.random.default_rng(3)
    p = rng.integers(0, 90, (40, 2))
    data = [(1, 0, i, *map(float, (x, y, x + w, y + h))) for i, ((x, y), (w, h)) in enumerate(zip(p, rng.integers(1, 30, (40, 2))))]
    g = spark.createDataFrame(data, BOX)
    pairs = [(r.a, r.b) for r in B.grid_pairs(g, g, 10).select(F.col("a.idx").alias("a"), F.col("b.idx").alias("b")).collect()]
    want = {(a[2], b[2]) for a, b in itertools.product(data, data) if a[3] < b[5] and b[3] < a[5] and a[4] < b[6] and b[4] < a[6]}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(*[st.floats(0, 1)] * 4), min_size=1, max_size=5), st.lists(st.tuples(*[st.floats(0, 1)] * 4), min_size=1, max_size=5))
def test_iou_and_assignment(a, b):
    norm = lambda q: np.array([(min(x, z), min(y, w), max(x, z), max(y, w)) for x, y, z, w in q])
    gain = B.iou_matrix(norm(a), norm(b))
    assert ((gain >= 0) & (gain <= 1 + 1e-9)).all() and np.allclose(gain, B.iou_matrix(norm(b), norm(a)).T)
    small, large = sorted(gain.shape)
    g = gain if gain.shape[0] <= gain.shape[1] else gain.T
    best = max(sum(g[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(large), small))
    assert abs(sum(gain[i, j] for i, j in M.assignment(gain)) - best) < 1e-9
    assert abs(sum(gain[i, j] for i, j in M.best_pairs(gain)) - best) < 1e-9


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 12)] * 4, st.integers(0, 3)), min_size=1, max_size=25), st.sampled_from([0.1, 0.3, 0.5]))
def test_suppression_is_greedy(raw, threshold):
    """Rounds of winners keep what the plain loop keeps."""
    boxes = np.array([(x, y, x + w, y + h) for x, y, w, h, _ in raw], float)
    score, index = np.array([r[4] for r in raw], float), np.arange(len(raw))
    kept = []
    for i in sorted(index, key=lambda i: (-score[i], -i)):
        size = lambda k: (boxes[k, 2] - boxes[k, 0]) * (boxes[k, 3] - boxes[k, 1])
        if all(B.iou_matrix(boxes[[k]], boxes[[i]])[0, 0] <= threshold and (size(k) > 0 or size(i) > 0) for k in kept):
            kept.append(i)
    assert sorted(B.kept_boxes(boxes, score, index, threshold).tolist()) == sorted(kept)


def test_polygon_batches():
    """All pairs at once give what clipping gives pair by pair."""
    rng = np.random.default_rng(5)
    c, s, angle = rng.random((300, 1, 2)), rng.random((300, 1, 2)) + 0.1, rng.random(300) * 3
    corner = np.array([(-1, -1), (1, -1), (1, 1), (-1, 1)]) / 2
    turn = np.stack([np.stack([np.cos(angle), -np.sin(angle)], 1), np.stack([np.sin(angle), np.cos(angle)], 1)], 1)
    quads = np.einsum("nij,nkj->nki", turn, corner * s) + c
    a, b = quads[:150], np.concatenate([quads[150:250], quads[100:150]])
    b[140:] = a[140:]
    a[::7] = a[::7, ::-1]
    assert np.allclose(B.polygon_ious(a, b), [B.polygon_iou(x, y) for x, y in zip(a, b)], atol=1e-6)


def test_polygons():
    unit = [(0, 0), (1, 0), (1, 1), (0, 1)]
    assert abs(B.polygon_iou(unit, [(0.5, 0), (1.5, 0), (1.5, 1), (0.5, 1)]) - 1 / 3) < 1e-9
    assert B.polygon_iou(unit, [(2, 2), (3, 2), (3, 3)]) == 0 and abs(B.polygon_iou(unit, unit[::-1]) - 1) < 1e-9
    r = B.least_rectangle([(0, 1), (1, 0), (2, 1), (1, 2), (1, 1)])
    assert abs(abs(B.signed_area(r)) - 2) < 1e-6


def test_localisation(spark):
    t = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 1.0, 1.0)], BOX)
    p = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 0.5, 0.5), (1, 0, 1, 0.6, 0.6, 0.7, 0.7)], BOX)
    keys = ["doc_id", "page_idx"]
    assert tuple(M.localisation(M.page_matches(t, p, keys, threshold=0.2)).first())[:3] == (1, 0.5, 0.13)
    assert tuple(M.localisation(M.page_matches(t, p, keys, threshold=0.5)).first())[:3] == (0, 0, 0.13)
    two = t.union(t.withColumn("page_idx", F.lit(1).cast("long")))
    assert tuple(M.localisation(M.page_matches(two, t, keys)).first())[:3] == (0.5, 1, 1)
    assert tuple(M.localisation(M.page_matches(t.limit(0), t.limit(0), keys)).first())[:3] == (None, None, None)


def test_labelled_metrics(spark):
    """Words at four levels, classes, and table cells."""
    box = BOX + ", value string, class long, row_start int, row_end int, col_start int, col_end int"
    at = lambda i, v, c, row, col: (1, 0, i, 10.0 * i, 0.0, 10.0 * i + 8, 8.0, v, c, row, row, col, col)
    t = spark.createDataFrame([at(0, "Été", 1, 0, 0), at(1, "b", 1, 0, 1), at(2, "c", 2, 1, 0), at(3, "d", 2, 1, 1)], box)
    p = spark.createDataFrame([at(0, "été", 1, 0, 0), at(1, "b", 2, 0, 1), at(2, "C", 2, 1, 1), at(9, "x", 2, 3, 3), at(8, "x", 2, 3, 3)], box)
    m = M.ocr_metric(t, p, KEYS).first()
    assert (m.recall, m.precision, m.raw_recall, m.caseless_recall, m.folded_recall, m.unicase_precision) == (0.75, 0.6, 0.25, 0.75, 0.25, 0.6)
    assert tuple(M.detection_metric(t, p, KEYS, "class").first()) == (0.5, 0.4, 0.6)
    c = M.cell_metric(t, p, KEYS).first()
    assert (c.recall, c.precision) == (0.75, 0.6) and abs(c.f1 - 2 / 3) < 1e-9 and abs(c.structure_accuracy - 2 / 3) < 1e-9
    assert tuple(M.cell_metric(t, p.limit(0), KEYS).first()) == (0, None, None, None)


def test_running_count(spark):
    """Two-level ranks with one score on a third of the rows, against a sort."""
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(2)), float(s), i) for i, s in enumerate(np.where(rng.random(900) < 0.35, 0.5, rng.random(900).round(2)))]
    got = {r.order: r.seen for r in M.running_count(spark.createDataFrame(rows, "c long, score double, order long"), ["c"], "seen").collect()}
    for c in (0, 1):
        mine = sorted((-s, i) for k, s, i in rows if k == c)
        assert [got[i] for _, i in mine] == list(range(1, len(mine) + 1))


def test_average_precision(spark):
    truth = spark.createDataFrame([(1,), (1,), (2,)], "c long")
    det = spark.createDataFrame([(1, 0.9, 1, 1, 0.9), (1, 0.8, 2, 2, 0.6), (1, 0.7, 3, 1, 0.95), (3, 0.5, 4, None, None)], "c long, score double, order long, truth_id long, iou double")
    got = {(r.c, r.threshold): r.ap for r in M.average_precision(det, truth, "c", [0.5, 0.75]).collect()}
    assert abs(got[1, 0.5] - 1) < 1e-9 and abs(got[1, 0.75] - 51 / 101) < 1e-9 and got[2, 0.5] == 0 and (3, 0.5) not in got


def columns(n=4):
    return [(0.1, 0.1 + 0.2 * i, 0.45, 0.25 + 0.2 * i) for i in range(n)] + [(0.55, 0.1 + 0.2 * i, 0.9, 0.25 + 0.2 * i) for i in range(n)]


def test_gutter():
    two, one = np.array(columns()), np.array([(0.1, 0.1 * i, 0.9, 0.1 * i + 0.08) for i in range(6)])
    assert gutter(two) and not gutter(one) and not gutter(np.concatenate([two[:1], one]))
    assert gutter(np.concatenate([two, [(0.1, 0.01, 0.9, 0.05)]]))  # one heading across


def test_reading_order():
    order = lambda b, **k: reading_order(np.array(b).reshape(-1, 4), **k)
    assert order([]) == [] and order([(0, 0, 1, 1)]) == [0]
    assert order([(0.1, 0.5, 0.9, 0.6), (0.1, 0.1, 0.9, 0.2), (0.1, 0.3, 0.9, 0.4)]) == [1, 2, 0]
    assert order([(0.55, 0.2, 0.9, 0.8), (0.1, 0.05, 0.9, 0.15), (0.1, 0.2, 0.45, 0.8)]) == [1, 2, 0]
    assert order(columns()) == list(range(8)) and order(columns(), direction="rtl") == [4, 5, 6, 7, 0, 1, 2, 3]
    for seed in range(5):
        perm = np.random.default_rng(seed).permutation(8)
        assert [int(perm[i]) for i in order(np.array(columns())[perm])] == list(range(8))
    tall = [(0.8 - 0.15 * i, 0.1, 0.9 - 0.15 * i, 0.9) for i in range(4)]
    assert order(tall, direction="ttb-rtl") == [0, 1, 2, 3] and order(tall, direction="ttb-ltr") == [3, 2, 1, 0]
    page = [(0.1, 0.92, 0.9, 0.97), (0.1, 0.02, 0.9, 0.06), (0.1, 0.1, 0.9, 0.4), (0.1, 0.45, 0.5, 0.7), (0.1, 0.71, 0.5, 0.75), (0.55, 0.45, 0.9, 0.88), (0.1, 0.8, 0.5, 0.84)]
    labels = ["Page-footer", "Page-header", "Text", "Picture", "Caption", "Text", "Footnote"]
    assert order(page, labels=labels) == [1, 2, 3, 4, 5, 6, 0]
    page[4] = (0.1, 0.41, 0.5, 0.44)
    assert order(page, labels=labels) == [1, 2, 4, 3, 5, 6, 0]
    assert sorted(order([(0.1, 0.1, 0.1, 0.1)] * 3 + [(0.5, 0.5, 0.5, 0.5)])) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        order(page, direction="up")
    assert canonical(np.array([(0, 0, 1, 1), (2, 0, 3, 1)], float), "rtl")[0].tolist() == [2, 0, 3, 1]


def test_segments_and_labels(spark):
    rows = [(1, 0, i, 0.1, y, 0.9, y + 0.03) for i, y in enumerate((0.1, 0.15, 0.2, 0.4, 0.45))]
    df = spark.createDataFrame(rows, BOX)
    assert [r.segment_idx for r in reading_segments(df, ["doc_id", "page_idx"], "idx").orderBy("idx").collect()] == [0, 0, 0, 1, 1]
    named = df.join(spark.createDataFrame([(0, "Text"), (1, "text"), (2, "Title"), (3, "Table"), (4, "Table")], "idx long, type string"), "idx")
    assert [r.segment_idx for r in reading_segments(named, ["doc_id", "page_idx"], "idx", label="type").orderBy("idx").collect()] == [0, 0, 1, 2, 3]
    tall = spark.createDataFrame([(1, 0, i, 0.8 - 0.05 * i, 0.1, 0.84 - 0.05 * i, 0.9) for i in range(3)], BOX)
    assert [r.segment_idx for r in reading_segments(tall, ["doc_id", "page_idx"], "idx", direction="ttb-rtl").orderBy("idx").collect()] == [0, 0, 0]
    regions = spark.createDataFrame([(1, 0, 0, "Title", 0.05, 0.05, 0.95, 0.14), (1, 0, 1, "Text", 0.05, 0.14, 0.95, 0.3)], "doc_id long, page_idx long, region_idx long, type string, x0 double, y0 double, x1 double, y1 double")
    assert [r.type for r in covering_labels(df, regions, ["doc_id", "page_idx"], "idx").orderBy("idx").collect()] == ["Title", "Text", "Text", None, None]


def test_rows_and_blocks(spark):
    words = [(1, 0, i, f"w{i}", x, y, x + 100, y + 18, 90) for i, (x, y) in enumerate([(0, 100), (110, 102), (400, 99), (0, 200), (110, 200)])]
    w = spark.createDataFrame(words, "doc_id long, page_idx long, word_idx long, value string, x0 long, y0 long, x1 long, y1 long, confidence_pct long")
    t = L.line_table(L.resolve_lines(w)).orderBy("line_idx").collect()
    assert [r.text for r in t] == ["w0 w1", "w2", "w3 w4"]
    b = L.resolve_blocks(L.line_table(L.resolve_lines(w))).orderBy("line_idx").collect()
    assert len(b) == 3 and b[0].block_idx == 0
    assert L.line_table(L.resolve_lines(w.limit(0))).collect() == []


ITEMS = "doc_id long, page_idx long, position long, label string, lines array<string>, table string"
KEYS = ["doc_id", "page_idx"]


def test_cell_rows(spark):
    """Two lines in a cell do not interleave; a word in no cell is left out, one near goes to the nearest."""
    w = spark.createDataFrame([(1, 0, i, v, x, y, x + 40, y + 10, c) for i, (v, x, y, c) in enumerate([("second", 0, 22, 80), ("line", 50, 20, 90), ("first", 0, 0, 70), ("row", 50, 3, 60), ("far", 900, 900, 50), ("near", 85, 50, 40)])], "doc_id long, page_idx long, word_idx long, value string, x0 long, y0 long, x1 long, y1 long, confidence_pct long")
    g = spark.createDataFrame([(1, 0, 0, 0, 0, 0, 100, 40), (1, 0, 0, 1, 0, 60, 200, 100)], "doc_id long, page_idx long, table_idx long, cell_idx long, x0 long, y0 long, x1 long, y1 long")
    got = {r.cell_idx: (r.value, r.confidence_pct, r.n_words) for r in B.cell_text(B.containing_cells(w, g, KEYS), KEYS).collect()}
    assert got == {0: ("first row second line", 75.0, 4), 1: ("near", 40.0, 1)}
    assert B.containing_cells(w, g.limit(0), KEYS).collect() == [] and B.cell_text(B.containing_cells(w.limit(0), g, KEYS), KEYS).collect() == []


def test_exports(spark):
    items = spark.createDataFrame(
        [(1, 0, 0, "Title", ["A*B", " ", "C"], None), (1, 0, 1, "List-item", ["x", "y"], None), (1, 0, 2, "list item", ["1. y"], None), (1, 0, 3, "Text", ["a<b", "- {c}"], None), (1, 0, 4, "Footnote", ["9"], None), (1, 0, 5, "Text", [" "], None), (1, 0, 6, None, None, None), (1, 0, 7, "Table", None, "T"), (1, 0, 8, "Table", None, "")], ITEMS
    )
    text = lambda f, **k: E.page_text(items, KEYS, f, **k).first().text
    assert text("txt", furniture=False) == "A*B\nC\n\nx y\n1. y\n\na<b\n- {c}\n\nT"
    assert text(" MD ") == "# A\\*B C\n\n- x y\n- \\1. y\n\na\\<b\n\\- {c}\n\n\\9\n\nT"
    assert text("md", escape=False, furniture=False, block_break="|") == "# A*B C|- x y\n- 1. y|a<b\n- {c}|T"
    assert text("adoc", furniture=False) == "== A\\*B C\n\n* x y\n* 1. y\n\na\\<b\n{empty}- \\{c\\}\n\nT"
    assert text("html") == "<h1>A*B C</h1>\n<ul>\n<li>x y</li>\n<li>1. y</li>\n</ul>\n<p>a&lt;b<br>\n- {c}</p>\n<p>9</p>\nT"
    with pytest.raises(ValueError, match="known are"):
        E.format_name("pdf")
    both = items.union(items.withColumn("page_idx", F.lit(1).cast("long")))
    for form, gap in (("text", "\n\n\n\n"), ("md", "\n\n---\n\n"), ("adoc", "\n\n<<<\n\n"), ("html", "\n<hr>\n")):
        one, two = E.export_as(form, KEYS, items).first().text, E.documents_as(form, E.export_as(form, KEYS, both), "doc_id", "page_idx").first().text
        assert two == one + gap + one
    cells = spark.createDataFrame([(1, 0, 0, 0, 0, 1, "h|"), (1, 1, 1, 1, 0, 0, "a"), (1, 2, 1, 1, 1, 1, None), (1, 3, 1, 1, 0, 0, "b\nc ")], "t long, cell_idx long, row_start int, row_end int, col_start int, col_end int, value string")
    rows = E.grid_rows(cells, ["t"])
    assert E.table_text(rows.filter("row_idx = 0"), ["t"]).first().text == "h|\t"
    assert E.table_text(rows, ["t"], "md").first().text == "| h\\| |  |\n| --- | --- |\n| b c |  |"
    assert E.table_text(rows, ["t"], "adoc").first().text == "|===\n|h\\| |\n\n|b c |\n|==="
    assert E.table_text(rows, ["t"], "html").first().text == "<table>\n<tr><th>h|</th><th></th></tr>\n<tr><td>b\nc</td><td></td></tr>\n</table>"


@pytest.mark.parametrize("line, markdown", [("#x", "\\#x"), ("+ x", "\\+ x"), ("= x", "\\= x"), ("12. x", "\\12. x"), ("12", "\\12"), ("1) x", "1) x"), ("1.5 x", "1.5 x"), ("  - x", "\\  - x"), ("`x`", "\\`x\\`"), ("{x}", "{x}"), ("x", "x")])
def test_markdown_lines(spark, line, markdown):
    df = spark.createDataFrame([(1, 0, 0, "Text", [line], None)], ITEMS)
    assert E.page_text(df, KEYS, "md").first().text == markdown


def test_hocr(spark):
    """Well-formed, numbered through the page, boxes in pixels."""
    from xml.etree import ElementTree

    words = spark.createDataFrame([(1, 0, b, li, k, v, 0.1 * k, 0.1 * li, 0.1 * k + 0.05, 0.1 * li + 0.02, 0.905, "fr") for k, (b, li, v) in enumerate([(0, 0, "a&b"), (0, 0, "c"), (0, 1, "d"), (1, 2, "<e>")])], "doc_id long, page_idx long, block_idx long, line_idx long, word_idx long, value string, x0 double, y0 double, x1 double, y1 double, confidence double, language string")
    root = ElementTree.fromstring(E.export_as("hocr", KEYS, words=words, width=200, height=100).first().hocr)
    ns = "{http://www.w3.org/1999/xhtml}"
    found = [(x.get("class"), x.get("id")) for x in root.iter() if x.get("id")]
    assert found == [("ocr_page", "page_1"), ("ocr_carea", "block_1"), ("ocr_par", "par_1"), ("ocr_line", "line_1"), ("ocrx_word", "word_1"), ("ocrx_word", "word_2"), ("ocr_line", "line_2"), ("ocrx_word", "word_3"), ("ocr_carea", "block_2"), ("ocr_par", "par_2"), ("ocr_line", "line_3"), ("ocrx_word", "word_4")]
    spans = {x.get("id"): x for x in root.iter(ns + "span")}
    assert spans["word_1"].text == "a&b" and spans["word_1"].get("title") == "bbox 0 0 10 2; x_wconf 90" and spans["line_1"].get("title") == "bbox 0 0 30 2; baseline 0 0; x_size 2; x_fsize 2; x_descenders 0; x_ascenders 0"
    assert root.get("{http://www.w3.org/XML/1998/namespace}lang") == "fr"
    cells = spark.createDataFrame([(1, 0, 0, 0, 1, "b", 0.5, 0.1, 0.6, 0.2, 0.5), (1, 0, 0, 0, 0, "a", 0.1, 0.1, 0.2, 0.2, 0.5), (1, 0, 0, 2, 0, None, 0.1, 0.3, 0.2, 0.4, 1.0)], "doc_id long, page_idx long, table_idx long, row_start int, col_start int, value string, x0 double, y0 double, x1 double, y1 double, confidence double")
    t = ElementTree.fromstring(E.table_hocr(cells, KEYS, 100, 100).first().hocr)
    assert [(x.get("id"), x.text) for x in t.iter("span")] == [("table_1_row_1", None), ("table_1_cell_1_1", "a"), ("table_1_cell_1_2", "b"), ("table_1_row_3", None), ("table_1_cell_3_1", None)]
    assert json.loads(E.page_json(words, KEYS).first().json)["lines"][0]["words"][0]["value"] == "a&b"


def test_predict(spark):
    pages = spark.createDataFrame([(1, "ab  cd"), (2, None)], "page_id long, text string")
    assert [(r.page_id, r.value) for r in read_pages(pages).orderBy("word_idx").collect()] == [(1, "ab"), (1, "cd")]
    parts = spark.createDataFrame([(1, 0, "abcX", 0.5), (1, 1, "Xdef", 1.0)], "crop long, window_idx long, value string, confidence double")
    assert tuple(regroup(parts, ["crop"]).first()) == (1, "abcdef", 0.75)
    cand = spark.createDataFrame([(0, "a", 0.9), (0, "b", 0.8), (1, "c", 0.1)], "step long, char string, score double")
    assert sorted((r.step, r.char) for r in whitelisted(cand, "bc", ["step"]).collect()) == [(0, "b"), (1, "c")]


def test_queries_and_kie(spark):
    logits = spark.createDataFrame([(1, 0, [4.0, -4.0]), (1, 1, [0.0, 1.0])], "page long, query_idx long, logits array<double>")
    assert sorted((r.query_idx, r.class_idx) for r in B.top_queries(logits, ["page"], 3, 0.5).collect()) == [(0, 0), (1, 1)]
    p = spark.createDataFrame([(1, 0, "date", 1, "b"), (1, 0, "date", 0, "a"), (1, 1, "sum", 0, "9*")], "page long, class_idx long, class_name string, position long, value string")
    assert E.export_as("text", ["page"], predictions=p).first().text == "date:\n\na\nb\n\nsum:\n\n9*"
    assert E.kie_text(p, ["page"], "md").first().text == "**date**\n\n- a\n- b\n\n**sum**\n\n- 9\\*"
    assert E.kie_text(p, ["page"], "adoc").first().text == "*date*\n\n* a\n* b\n\n*sum*\n\n* 9\\*"
    assert E.kie_text(p, ["page"], "html").first().text == "<h3>date</h3>\n<ul>\n<li>a</li>\n<li>b</li>\n</ul>\n<h3>sum</h3>\n<ul>\n<li>9*</li>\n</ul>"
    boxed = p.withColumns({c: F.lit(v) for c, v in (("x0", 0.1), ("y0", 0.1), ("x1", 0.2), ("y1", 0.2), ("confidence", 0.5))})
    assert E.export_as("xml", ["page"], predictions=boxed, page="page", width=10, height=10).first().hocr.count('class="ocr_carea" id="') == 3
    assert E.kie_lines(p, ["page"]).first().text == "date: a\n\ndate: b\n\nsum: 9*"
