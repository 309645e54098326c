"""Pixel kernels against plain loops, and alphabets and predictors over tables."""

import numpy as np
import pandas as pd
import pytest

from paperloom.operators import predict as P
from paperloom.operators import raster as R

RNG = np.random.default_rng(1)
IMG = RNG.integers(1, 255, (12, 16, 3)).astype(np.uint8)


def test_geometry_of_pixels():
    assert (R.stretched(IMG, 12, 16) == IMG).all() and R.stretched(np.full((4, 4, 3), 7, np.uint8), 9, 3).tolist() == np.full((9, 3, 3), 7).tolist()
    box = R.letterboxed(IMG, 16, 16)
    assert (box[2:14] == IMG).all() and not box[:2].any() and not box[14:].any() and (R.letterboxed(IMG, 16, 16, centred=False)[:12] == IMG).all()
    assert (R.turned(IMG, 0) == IMG).all() and (R.turned(IMG, 90, expand=True) == np.rot90(IMG)).all() and (R.turned(IMG, 180) == IMG[::-1, ::-1]).all()
    framed = np.pad(IMG, ((3, 1), (2, 5), (0, 0)))
    assert (R.trimmed(framed) == IMG).all() and R.trimmed(np.zeros((3, 3, 3), np.uint8)).size == 0
    page, matrix = R.straightened(IMG, 90)
    x, y, _ = matrix @ [4, 6, 1]
    assert (page[6, 4] == IMG[round(y), round(x)]).all()
    assert [c.shape for c in R.crops(IMG, [(0, 0, 0.5, 0.5), (0.25, 0.25, 1, 1)])] == [(7, 9, 3), (9, 12, 3)]
    quad = np.array([(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)])
    assert (R.quad_crops(IMG, [quad])[0] == IMG[3:9, 4:12]).all() and R.quad_crops(IMG, [quad * 0])[0].size == 0
    assert (R.quarter_turned([IMG], [1])[0] == np.rot90(IMG, -1)).all()
    assert R.prepared(IMG, 8, 8).shape == (3, 8, 8) and abs(float(R.prepared(np.full((8, 8, 3), 255, np.uint8), 8, 8).mean()) - 0.5) < 1e-6


def test_masks_and_parts():
    out = R.masked(IMG, [(0.5, 0.5, 1, 1), (0, 0, 0.2, 0, 0.2, 0.2, 0, 0.2)])
    assert (out[6:, 8:] == 255).all() and (out[:2, :3] == 255).all() and (out[:5, 5:] == IMG[:5, 5:]).all()
    bitmap = RNG.random((20, 25)) < 0.55
    label, seen = R.components_of(bitmap), {}
    for y, x in zip(*np.nonzero(bitmap)):
        if (y, x) in seen:
            continue
        stack = [(y, x)]
        while stack:
            p = stack.pop()
            if p not in seen and 0 <= p[0] < 20 and 0 <= p[1] < 25 and bitmap[p]:
                seen[p] = label[y, x]
                stack += [(p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)]
    assert all(label[p] == n for p, n in seen.items()) and (label > 0).sum() == len(seen)
    assert len(set(seen.values())) == len(np.unique(label[label > 0]))
    p = np.zeros((40, 40))
    p[10:14, 10:20], p[30:31, 30:31], p[20:26, 20:30] = 0.9, 0.9, 0.35
    boxes = R.probability_boxes(p, ratio=0.0)
    assert np.allclose(boxes, [(0.25, 0.25, 0.5, 0.35, 0.9), (0.5, 0.5, 0.75, 0.65, 0.35)])
    grown = R.probability_boxes(p, least_score=0.5)
    assert len(grown) == 1 and grown[0, 0] < 0.25 and grown[0, 3] > 0.35 and R.probability_boxes(p * 0).shape == (0, 5)
    assert R.box_score(p, np.array([(10, 10), (19, 10), (19, 13), (10, 13)], float)) == pytest.approx(0.9)
    assert R.page_skew([(30, 2, 1.5), (40, 2, 2.5), (5, 5, 80)]) == 1.5 and R.page_skew([]) == 0.0


def test_augmentations(spark):
    rows = [(i, 12, 16, bytearray(IMG.tobytes())) for i in range(4)] + [(9, 1, 1, None)]
    df = spark.createDataFrame(rows, "id long, height int, width int, pixels binary")
    kernel = R.sequence(R.one_of(R.inverted(), R.shuffled()), R.sometimes(R.noisy(0, 0.1)), R.blurred(0.5, 1.5), R.mirrored(), R.shadowed(), R.resized(share=1.0))
    a, b = ({r.id: r for r in R.mapped(df, kernel, "id", 3).collect()} for _ in range(2))
    assert a == b and a[9].pixels is None and all(len(r.pixels) == r.height * r.width * 3 for k, r in a.items() if k < 9)
    assert len({bytes(r.pixels) for k, r in a.items() if k < 9}) == 4
    rng = np.random.default_rng(0)
    assert (np.asarray(R.inverted(1.0)(IMG, rng)) == 255 - IMG).all() and (R.mirrored(1.0)(IMG, rng) == IMG[:, ::-1]).all()
    flat = np.full((9, 9, 3), 50, np.uint8)
    assert (R.blurred(1, 2)(flat, rng) == 50).all() and (R.shadowed()(flat, rng) <= 50).all()
    for _ in range(20):
        x0, y0, x1, y1 = R.window()(12, 16, rng)
        assert 0 <= x0 < x1 <= 16 and 0 <= y0 < y1 <= 12
    assert R.spun(5, True)(IMG, rng).shape[0] >= 12


def test_alphabets(spark):
    near = P.nearest_allowed("abcàéÉŒz", "aeo")
    assert near == {"à": "a", "é": "e", "É": "e"}
    cand = spark.createDataFrame([(0, "é", 0.9), (0, "a", 0.8), (1, "z", 0.9), (1, "a", 0.1)], "step long, char string, score double")
    best = lambda **k: {r.step: r.char for r in P.restricted(cand, "aezé", "ae", ["step"], **k).collect()}
    assert best() == {0: "a", 1: "a"} and best(strategy="nearest") == {0: "e", 1: "a"} and best(strategy="nearest", mapping={"z": "e"}) == {0: "a", 1: "e"}
    for bad in ({"strategy": "x"}, {"allowed": "q"}):
        with pytest.raises(ValueError):
            P.restricted(cand, "aezé", bad.pop("allowed", "ae"), ["step"], **bad)


def test_key_information_and_tables(spark):
    def detector(pages: pd.DataFrame) -> pd.DataFrame:
        return P.grid_detector(pages).assign(**{"class": lambda d: ["date" if k % 2 else "sum" for k in d.word_idx]})

    pages = spark.createDataFrame([(1, "ab cd ef")], "page_id long, text string")
    assert sorted((r["class"], r.position, r.value) for r in P.kie_pages(pages, detector).collect()) == [("date", 0, "cd"), ("sum", 0, "ab"), ("sum", 1, "ef")]

    def halves(regions: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(r.page, r.region_idx, k, k / 2, 0.0, k / 2 + 0.5, 1.0, 0, 0, k, k) for r in regions.itertuples() for k in range(2)], columns="page region_idx cell_idx x0 y0 x1 y1 row_start row_end col_start col_end".split())

    regions = spark.createDataFrame([(1, 0, "Text", 0.0, 0.0, 1.0, 0.2), (1, 1, "Table", 0.2, 0.4, 0.6, 0.8)], "page long, region_idx long, type string, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.region_idx, r.cell_idx, round(r.x0, 6), round(r.y0, 6), round(r.x1, 6), round(r.y1, 6), r.col_start) for r in P.table_cells(regions, halves, ["page"]).collect())
    assert got == [(1, 0, 0.2, 0.4, 0.4, 0.8, 0), (1, 1, 0.4, 0.4, 0.6, 0.8, 1)]
