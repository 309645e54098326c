"""Geometry as pure column expressions; boxes are four columns, polygons arrays of (x, y) structs."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_corners(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Corners in the order top left, top right, bottom left, bottom right."""
    return F.array(point(x0, y0), point(x1, y0), point(x0, y1), point(x1, y1))


def box_polygon(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Corners around the box, clockwise from the top left."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def polygon_box(poly: Column) -> dict[str, Column]:
    """Enclosing box of a polygon."""
    xs, ys = F.transform(poly, lambda p: p["x"]), F.transform(poly, lambda p: p["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def flat_box(geometry: Column) -> dict[str, Column]:
    """Enclosing box of four or eight numbers."""
    xs, ys = F.filter(geometry, lambda _, i: i % 2 == 0), F.filter(geometry, lambda _, i: i % 2 == 1)
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def polygon_area(poly: Column) -> Column:
    """Shoelace area."""
    after = F.concat(F.slice(poly, 2, F.greatest(F.size(poly) - 1, F.lit(0))), F.slice(poly, 1, 1))
    cross = F.zip_with(poly, after, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def ordered_points(poly: Column) -> Column:
    """Quad as top left, top right, bottom right, bottom left: by angle about the centroid, from the least x + y.

    One fold gives the centroid and one sort the ring; the first point is found
    by sorting the ring's places, so that nothing is worked out twice.
    """
    total = F.aggregate(poly, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), lambda s, p: F.struct((s["x"] + p["x"]).alias("x"), (s["y"] + p["y"]).alias("y")))
    n = F.size(poly)

    def ring(c: Column) -> Column:
        angles = F.transform(poly, lambda p: F.struct(F.atan2(p["y"] - c["y"] / n, p["x"] - c["x"] / n).alias("a"), p["x"].alias("x"), p["y"].alias("y")))
        return F.array_sort(angles)

    def turned(r: Column) -> Column:
        first = F.array_min(F.transform(r, lambda p, i: F.struct((p["x"] + p["y"]).alias("s"), i.alias("i"))))["i"]
        return F.transform(F.concat(F.slice(r, first + 1, n - first), F.slice(r, F.lit(1), first)), lambda p: point(p["x"], p["y"]))

    let = lambda value, body: F.transform(F.array(value), body)[0]  # noqa: E731  names a value inside an expression
    return let(total, lambda c: let(ring(c), turned))


def rotate_point(x: Column, y: Column, angle: float) -> tuple[Column, Column]:
    """Turned about the origin by degrees."""
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    return x * c - y * s, x * s + y * c


def expanded_shape(h: Column, w: Column, angle: float) -> tuple[Column, Column]:
    """Height and width of a canvas that holds the turned one."""
    c, s = abs(math.cos(math.radians(angle))), abs(math.sin(math.radians(angle)))
    return h * c + w * s, h * s + w * c


def rotate_box(x0: Column, y0: Column, x1: Column, y1: Column, angle: float, h: Column, w: Column, min_angle: float = 1.0) -> Column:
    """Relative box turned about the page's centre, as a polygon; unchanged for nearly right angles."""
    poly = box_polygon(x0, y0, x1, y1)
    if abs(angle) < min_angle or abs(angle) > 90 - min_angle:
        return poly
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))

    def turn(p: Column) -> Column:
        x, y = (p["x"] - 0.5) * w, (0.5 - p["y"]) * h
        return point((x * c - y * s) / w + 0.5, 0.5 - (x * s + y * c) / h)

    return F.transform(poly, turn)


def remap(v: Column, old: Column, new: Column) -> Column:
    """Relative coordinate under a centred change of the canvas size."""
    return (v * old + (new - old) / 2) / new


def unpadded(x: Column, y: Column, h: Column, w: Column, symmetric: bool) -> tuple[Column, Column]:
    """Inverse of a letterbox to a square: the padded axis is stretched and clipped."""
    mid = 0.5 if symmetric else 0.0
    grow = lambda v, f: clip((v - mid) * f + mid, 0.0, 1.0)
    return F.when(h > w, grow(x, h / w)).otherwise(x), F.when(w > h, grow(y, w / h)).otherwise(y)


def clip(v: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(v, F.lit(low)), F.lit(high))


def relative(v: Column, size: Column) -> Column:
    return clip(v / size, 0.0, 1.0)


def crop(low: Column, high: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """One axis of a box inside a window, from the window's start."""
    return F.greatest(low, start) - start, F.least(high, end) - start


def intersection(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def area(b: tuple[Column, ...]) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union; 0 where the union is empty."""
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both.cast("double") / union).otherwise(F.lit(0.0))


def overlap_ratio(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap of two intervals against the shorter one."""
    shorter = F.least(a1 - a0, b1 - b0)
    return F.when(shorter > 0, F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0)).cast("double") / shorter).otherwise(F.lit(0.0))


def word_angle(poly: Column) -> Column:
    """Slope, in degrees, from the middle of the left edge to that of the right one."""
    dx = (poly[1]["x"] + poly[2]["x"] - poly[0]["x"] - poly[3]["x"]) / 2
    dy = (poly[0]["y"] + poly[3]["y"] - poly[1]["y"] - poly[2]["y"]) / 2
    return F.when((dx == 0) & (dy == 0), F.lit(None)).when(dx == 0, F.when(dy > 0, 90.0).otherwise(-90.0)).otherwise(F.degrees(F.atan(dy / dx)))


def in_polygon(x: Column, y: Column, poly: Column) -> Column:
    """Ray casting with half-open edges."""
    after = F.concat(F.slice(poly, 2, F.size(poly) - 1), F.slice(poly, 1, 1))
    crosses = F.zip_with(poly, after, lambda a, b: F.when(((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"] + 1e-12) + a["x"]), 1).otherwise(0))
    return F.aggregate(crosses, F.lit(0), lambda s, v: s + v) % 2 == 1


def shifted_vertices(poly: Column, quarter_turns: Column) -> Column:
    """Vertices in an order turned by quarter turns."""
    k = F.pmod(quarter_turns, F.size(poly))
    return F.concat(F.slice(poly, k + 1, F.size(poly) - k), F.slice(poly, F.lit(1), k))


def window_starts(width: Column, window: Column, step: Column) -> Column:
    """Starts of overlapping windows; the last is flush with the end."""
    last = width - window
    return F.array_union(F.sequence(F.lit(0).cast("bigint"), F.greatest(last, F.lit(0)).cast("bigint"), step.cast("bigint")), F.array(F.greatest(last, F.lit(0)).cast("bigint")))


def gaussian_radius(w: Column, h: Column, overlap: float = 0.7) -> Column:
    """Least of the three radii at which a shifted box keeps the overlap."""
    r1 = (h + w - F.sqrt((h + w) * (h + w) - 4 * (w * h * (1 - overlap) / (1 + overlap)))) / 2
    r2 = (2 * (h + w) - F.sqrt(4 * (h + w) * (h + w) - 16 * (1 - overlap) * w * h)) / 8
    r3 = (-2 * overlap * (h + w) + F.sqrt(4 * overlap * overlap * (h + w) * (h + w) - 16 * overlap * (overlap - 1) * w * h)) / (8 * overlap)
    return F.least(r1, r2, r3)


def affine(x: Column, y: Column, matrix: list[list[Column]], w: Column, h: Column) -> tuple[Column, Column]:
    """Point under a 3 x 3 matrix, clipped to the canvas and made relative to it."""
    row = lambda r: r[0] * x + r[1] * y + r[2]
    d = row(matrix[2])
    return F.least(F.greatest(row(matrix[0]) / d, F.lit(0.0)), w - 1) / w, F.least(F.greatest(row(matrix[1]) / d, F.lit(0.0)), h - 1) / h


def upright(poly: Column, angle: Column, center: Column) -> Column:
    """Polygon turned back by a page's angle; unchanged below one degree and from 45 on."""
    c, s = F.cos(F.radians(angle)), F.sin(F.radians(angle))
    turned = F.transform(poly, lambda p: point((p["x"] - center["x"]) * c - (p["y"] - center["y"]) * s + center["x"], (p["x"] - center["x"]) * s + (p["y"] - center["y"]) * c + center["y"]))
    return F.when((F.abs(angle) >= 1) & (F.abs(angle) < 45), turned).otherwise(poly)


def oriented_box(cx: Column, cy: Column, w: Column, h: Column, sin: Column, cos: Column) -> Column:
    """Corners of a box given by centre, size and the sine and cosine of its angle."""
    n = F.sqrt(sin * sin + cos * cos)
    corner = lambda a, b: point(cx + (a * w * cos - b * h * sin) / n / 2, cy + (a * w * sin + b * h * cos) / n / 2)
    return F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1))


def sigmoid(v: Column) -> Column:
    return 1 / (1 + F.exp(-v))


def span_from_votes(votes: list[Column], near: tuple[int, int], far: tuple[int, int], span: Column) -> tuple[Column, Column]:
    """First and last index of a cell on one axis from its corners' votes and its span.

    The pair of corners at the start decides if its rounded votes agree, then
    the pair at the end, then the pair whose votes are closer.
    """
    span = F.greatest(span, F.lit(1))
    whole: Callable[[Column], Column] = lambda v: F.greatest(F.bround(v).cast("int"), F.lit(1))
    a, b, c, d = votes[near[0]], votes[near[1]], votes[far[0]], votes[far[1]]
    first = F.when(whole(a) == whole(b), whole(a))
    last = F.when(whole(c) == whole(d), F.greatest(span + 1, whole(c)) - 1)
    by_start = F.abs(a - b) <= F.abs(c - d)
    start = F.coalesce(first, last + 1 - span, F.when(by_start, whole((a + b) / 2)).otherwise(F.greatest(span + 1, F.bround((c + d) / 2).cast("int")) - span))
    return start, start + span - 1


def expanded_line(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> dict[str, Column]:
    """Both ends of a segment drawn out to the edge of the canvas along its own line; a point stays."""
    dx, dy = x1 - x0, y1 - y0
    flat, upright_ = dy == 0, dx == 0
    along_x = F.abs(dx) * height >= F.abs(dy) * width
    at_y = lambda x: y0 + (x - x0) * F.try_divide(dy, dx)
    at_x = lambda y: x0 + (y - y0) * F.try_divide(dx, dy)
    low, right, down = F.lit(0.0), width.cast("double"), height.cast("double")
    point_ = flat & upright_
    ends = {"x0": F.when(along_x, low).otherwise(at_x(low)), "y0": F.when(along_x, at_y(low)).otherwise(low), "x1": F.when(along_x, right).otherwise(at_x(down)), "y1": F.when(along_x, at_y(right)).otherwise(down)}
    was = {"x0": x0, "y0": y0, "x1": x1, "y1": y1}
    return {k: F.when(point_, was[k].cast("double")).otherwise(v) for k, v in ends.items()}


def gaussian_similarity(a: tuple[Column, ...], b: tuple[Column, ...], eps: float = 1e-7) -> Column:
    """Similarity of two oriented boxes (centre, size, angle in radians) taken as Gaussians: one less their Hellinger distance."""

    def spread(t: tuple[Column, ...]) -> tuple[Column, Column, Column]:
        u, v, c, s = t[2] * t[2] / 12, t[3] * t[3] / 12, F.cos(t[4]), F.sin(t[4])
        return u * c * c + v * s * s, u * s * s + v * c * c, (u - v) * c * s

    (a1, b1, c1), (a2, b2, c2) = spread(a), spread(b)
    sa, sb, sc = a1 + a2, b1 + b2, c1 + c2
    dx, dy = a[0] - b[0], a[1] - b[1]
    det = sa * sb - sc * sc
    t1 = (sa * dy * dy + sb * dx * dx) / (det + eps) / 4
    t2 = -sc * dx * dy / (det + eps) / 2
    inside = lambda p, q, r: F.greatest(p * q - r * r, F.lit(0.0))
    t3 = F.log(det / (4 * F.sqrt(inside(a1, b1, c1) * inside(a2, b2, c2)) + eps) + eps) / 2
    distance = F.least(F.greatest(t1 + t2 + t3, F.lit(eps)), F.lit(100.0))
    return 1 - F.sqrt(1 - F.exp(-distance) + eps)
