"""Geometry and text functions on literal cases."""

import math

import pytest
from pyspark.sql import functions as F

from paperloom.functions import geometry as G
from paperloom.functions import text as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def box(*v):
    return tuple(F.lit(float(x)) for x in v)


def test_boxes(spark):
    assert value(spark, G.iou(box(0, 0, 1, 1), box(0, 0, 0.5, 0.5))) == 0.25
    assert abs(value(spark, G.iou(box(0.2, 0.2, 0.6, 0.6), box(0.4, 0.4, 0.8, 0.8))) - 4 / 28) < 1e-9
    assert value(spark, G.iou(box(1, 1, 1, 1), box(1, 1, 1, 1))) == 0.0
    corners = [tuple(p) for p in value(spark, G.box_corners(*box(0, 0, 2, 1)))]
    assert corners == [(0, 0), (2, 0), (0, 1), (2, 1)]
    assert [tuple(p) for p in value(spark, G.ordered_points(G.box_corners(*box(0, 0, 2, 1))))] == [(0, 0), (2, 0), (2, 1), (0, 1)]
    assert value(spark, G.polygon_area(G.box_polygon(*box(0, 0, 2, 3)))) == 6.0
    assert [tuple(p) for p in value(spark, G.shifted_vertices(G.box_polygon(*box(0, 0, 2, 1)), F.lit(1)))] == [(2, 0), (2, 1), (0, 1), (0, 0)]
    assert value(spark, G.overlap_ratio(*box(0, 4, 3, 5))) == 0.5
    flat = value(spark, F.struct(*(v.alias(k) for k, v in G.flat_box(F.array(*map(F.lit, (3.0, 1.0, 2.0, 5.0, 0.0, 2.0, 1.0, 1.0)))).items())))
    assert tuple(flat) == (0.0, 1.0, 3.0, 5.0)


def test_rotation_padding_windows(spark):
    turned = value(spark, G.rotate_box(*box(0.4, 0.5, 0.6, 0.5), 90.0, F.lit(100.0), F.lit(100.0), min_angle=-1.0))
    assert abs(turned[0].x - 0.5) < 1e-9 and abs(turned[0].y - 0.6) < 1e-9
    same = value(spark, G.rotate_box(*box(0.1, 0.2, 0.3, 0.4), 0.5, F.lit(100.0), F.lit(50.0)))
    assert (same[0].x, same[0].y) == (0.1, 0.2)
    x, y = G.unpadded(F.lit(0.5), F.lit(0.9), F.lit(200.0), F.lit(100.0), False)
    assert (value(spark, x), value(spark, y)) == (1.0, 0.9)
    assert value(spark, G.window_starts(F.lit(100), F.lit(40), F.lit(20))) == [0, 20, 40, 60]
    assert value(spark, G.window_starts(F.lit(90), F.lit(40), F.lit(20))) == [0, 20, 40, 50]
    assert abs(value(spark, G.word_angle(F.array(*(G.point(F.lit(a), F.lit(b)) for a, b in ((0, 1), (1, 0), (1, 1), (0, 2)))))) - 45) < 1e-9
    h, w = G.expanded_shape(F.lit(10.0), F.lit(20.0), 90.0)
    assert round(value(spark, h), 6) == 20 and round(value(spark, w), 6) == 10
    assert value(spark, G.in_polygon(F.lit(0.5), F.lit(0.5), G.box_polygon(*box(0, 0, 1, 1)))) and not value(spark, G.in_polygon(F.lit(1.5), F.lit(0.5), G.box_polygon(*box(0, 0, 1, 1))))
    assert value(spark, G.gaussian_radius(F.lit(10.0), F.lit(10.0))) > 0 and math.isfinite(value(spark, G.relative(F.lit(5.0), F.lit(2.0))))


def test_match_levels(spark):
    pairs = [("grass", "grass"), ("56", "56"), ("True", "true"), ("EUR", "€")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.agg(*(F.avg(v.cast("int")).alias(k) for k, v in X.match_levels(F.col("a"), F.col("b")).items())).first()
    assert tuple(got) == (0.5, 0.75, 0.75, 1.0)
    df = spark.createDataFrame([("éléphant", "elephant"), ("ça", "ca")], "a string, b string")
    assert tuple(df.agg(*(F.avg(v.cast("int")).alias(k) for k, v in X.match_levels(F.col("a"), F.col("b")).items())).first()) == (0, 0, 1, 1)


def test_vocabulary(spark):
    assert value(spark, X.encoded(F.lit("bad"), "abcd")) == [1, 0, 3]
    assert value(spark, X.decoded(X.encoded(F.lit("bad"), "abcd"), "abcd")) == "bad"
    assert value(spark, X.padded(F.array(F.lit(1), F.lit(2)), 5, 9, 8, 7)) == [7, 1, 2, 9, 8]
    with pytest.raises(Exception, match="outside"):
        value(spark, X.encoded(F.lit("xyz"), "abcd"))
    assert value(spark, X.to_vocabulary(F.lit("é 漢a"), "abce")) == "e■a"
    assert [value(spark, X.text_direction(F.lit(t), F.lit(x))) for t, x in (("مرحبا abc", None), ("123", "ar"), ("", None), ("hello", "ar"))] == ["rtl", "rtl", "ltr", "ltr"]


def test_merge():
    cases = [("abcX", "Xdef", 0.5, "abcdef"), ("ababX", "Xabab", 0.8, "ababab"), ("one_differon", "ferent_letter", 0.5, "one_differont_letter"), ("abc", "", 0.5, "abc"), ("abcd", "cdefgh", 0.5, "abcefgh")]
    for a, b, o, want in cases:
        assert X.merge_pair(a, b, o) == want
    assert X.merge_all(["aaaa", "aaab", "aabc"], 0.8, 0.3) == "aaaabc" and X.merge_all([], 0.5, 0.5) == ""


def test_decoders(spark):
    step = {"-": [5.0, 0.0, 0.0], "a": [0.0, 5.0, 0.0], "b": [0.0, 0.0, 5.0]}
    lit = lambda s: F.array(*(F.array(*map(F.lit, step[c])) for c in s))
    assert [value(spark, X.ctc_decode(lit(s), "-ab", 0)[0]) for s in ("aa", "a-a", "-ab-b", "--")] == ["a", "aa", "abb", ""]
    text, confidence = X.attention_decode(lit("ab-b"), "-ab", 0, whole=False)
    assert value(spark, text) == "ab" and 0.9 < value(spark, confidence) < 1


def test_labels_and_markup(spark):
    rows = spark.createDataFrame([("Page-header",), ("Footnote",), ("Picture",), ("Title",), (None,)], "x string")
    assert [r.r for r in rows.select(X.label_role(F.col("x")).alias("r")).collect()] == ["header", "footnote", "float", "body", "body"]
    assert value(spark, X.markdown_escaped(F.lit("a*b_[c]"))) == r"a\*b\_\[c\]"
    assert value(spark, X.markdown_line(F.lit("1. x"))) == "\\1. x" and value(spark, X.markdown_line(F.lit("x"))) == "x"
    assert value(spark, X.html_escaped(F.lit('<a & "b">'))) == '&lt;a &amp; "b"&gt;'


def test_affine_upright_oriented(spark):
    m = [[F.lit(float(v)) for v in r] for r in ((1, 0, 10), (0, 1, -5), (0, 0, 1))]
    x, y = G.affine(F.lit(20.0), F.lit(2.0), m, F.lit(100.0), F.lit(50.0))
    assert (value(spark, x), value(spark, y)) == (0.3, 0.0)
    square = G.box_polygon(*box(0, 0, 2, 2))
    turned = value(spark, G.upright(square, F.lit(30.0), G.point(F.lit(1.0), F.lit(1.0))))
    assert abs(turned[0].x - (1 - math.cos(math.radians(30)) + math.sin(math.radians(30)))) < 1e-9
    assert [tuple(p) for p in value(spark, G.upright(square, F.lit(60.0), G.point(F.lit(1.0), F.lit(1.0))))] == [(0, 0), (2, 0), (2, 2), (0, 2)]
    flat = [tuple(round(v, 9) for v in p) for p in value(spark, G.oriented_box(*box(1, 1, 2, 4), F.lit(1.0), F.lit(0.0)))]
    assert sorted(flat) == [(-1, 0), (-1, 2), (3, 0), (3, 2)]


def test_cell_votes(spark):
    def span(v, n):
        start, end = G.span_from_votes([F.lit(float(x)) for x in v], (0, 3), (1, 2), F.lit(n))
        return value(spark, start), value(spark, end)

    assert span((2.1, 4.0, 4.2, 1.9), 2) == (2, 3)  # the start agrees
    assert span((1.4, 4.0, 4.2, 2.6), 2) == (2, 3)  # only the end agrees
    assert span((1.4, 3.4, 4.6, 1.6), 1) == (2, 2)  # neither: the closer pair, halves to even
    assert span((0.0, 9.0, 5.0, 0.2), 0) == (1, 1)
