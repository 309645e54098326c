"""Pixels: page rasters as rows, changed by NumPy kernels over Arrow batches.

A raster is a row with ``height``, ``width`` and ``pixels`` (height x width x 3
bytes).  ``mapped`` runs a kernel over every raster of a table; kernels are plain
functions of arrays, and the random ones take a generator seeded by the row's
key, so a lost task gives the same rows again.

Defined results: a null raster stays null; an empty crop is an empty raster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

Kernel = Callable[[np.ndarray, np.random.Generator], np.ndarray]


def mapped(rasters: DataFrame, kernel: Kernel, key: str, seed: int = 0) -> DataFrame:
    """The table with each raster changed by the kernel; other columns are kept."""
    names = rasters.columns
    at = {c: names.index(c) for c in ("height", "width", "pixels", key)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, bodies = [], []
            for k, h, w, body in zip(*(b.column(at[c]).to_pylist() for c in (key, "height", "width", "pixels"))):
                if body is None:
                    sizes.append((h, w))
                    bodies.append(None)
                    continue
                made = kernel(np.frombuffer(body, np.uint8).reshape(h, w, 3), np.random.default_rng(xxhash.xxh3_64_intdigest(f"{seed} {k}")))
                sizes.append(made.shape[:2])
                bodies.append(np.ascontiguousarray(made, np.uint8).tobytes())
            new = {"height": [s[0] for s in sizes], "width": [s[1] for s in sizes], "pixels": bodies}
            yield pa.RecordBatch.from_arrays([pa.array(new[c], b.schema.field(i).type) if c in new else b.column(i) for i, c in enumerate(names)], names)

    return rasters.mapInArrow(run, rasters.schema)


def sampled(img: np.ndarray, x: np.ndarray, y: np.ndarray, fill: float = 0.0) -> np.ndarray:
    """Bilinear values at places between pixels; ``fill`` outside."""
    h, w = img.shape[:2]
    inside = (x > -1) & (y > -1) & (x < w) & (y < h)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    out = np.zeros((*x.shape, img.shape[2]))
    for dx in (0, 1):
        for dy in (0, 1):
            px, py = x0 + dx, y0 + dy
            share = (1 - np.abs(x - px)) * (1 - np.abs(y - py))
            real = (px >= 0) & (py >= 0) & (px < w) & (py < h)
            value = np.where(real[..., None], img[np.clip(py, 0, h - 1), np.clip(px, 0, w - 1)], fill)
            out += share[..., None] * value
    return np.where(inside[..., None], out, fill)


def stretched(img: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize, pixel centres on pixel centres."""
    h, w = img.shape[:2]
    y, x = np.meshgrid(np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1), np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1), indexing="ij")
    return np.rint(sampled(img, x, y)).astype(np.uint8)


def letterboxed(img: np.ndarray, height: int, width: int, keep_ratio: bool = True, centred: bool = True) -> np.ndarray:
    """Resize to a canvas, padded with black where the ratio is kept."""
    if not keep_ratio:
        return stretched(img, height, width)
    h, w = img.shape[:2]
    scale = min(height / h, width / w)
    nh, nw = min(height, max(1, round(h * scale))), min(width, max(1, round(w * scale)))
    out = np.zeros((height, width, 3), np.uint8)
    top, left = ((height - nh) // 2, (width - nw) // 2) if centred else (0, 0)
    out[top : top + nh, left : left + nw] = stretched(img, nh, nw)
    return out


def prepared(img: np.ndarray, height: int, width: int, mean: float = 0.5, std: float = 1.0) -> np.ndarray:
    """Input of a model: channels first, scaled to 0..1 and normalised."""
    return ((letterboxed(img, height, width).astype(np.float32) / 255 - mean) / std).transpose(2, 0, 1)


def turned(img: np.ndarray, angle: float, expand: bool = False) -> np.ndarray:
    """Turned counter-clockwise by degrees about the centre; on a canvas that holds all of it, if asked."""
    h, w = img.shape[:2]
    c, s = np.cos(np.radians(angle)), np.sin(np.radians(angle))
    nh, nw = (int(np.ceil(h * abs(c) + w * abs(s) - 1e-9)), int(np.ceil(w * abs(c) + h * abs(s) - 1e-9))) if expand else (h, w)
    y, x = np.meshgrid(np.arange(nh) - (nh - 1) / 2, np.arange(nw) - (nw - 1) / 2, indexing="ij")
    return np.rint(sampled(img, x * c - y * s + (w - 1) / 2, x * s + y * c + (h - 1) / 2)).astype(np.uint8)


def trimmed(img: np.ndarray) -> np.ndarray:
    """Without black rows and columns at the edges."""
    lit = img.any(axis=2)
    rows, cols = np.flatnonzero(lit.any(axis=1)), np.flatnonzero(lit.any(axis=0))
    return img[rows[0] : rows[-1] + 1, cols[0] : cols[-1] + 1] if len(rows) else img[:0, :0]


def straightened(img: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """The page turned back, and the 3 x 3 matrix that takes its points to the page as it was."""
    out = turned(img, -angle, expand=True)
    (h, w), (nh, nw) = img.shape[:2], out.shape[:2]
    c, s = np.cos(np.radians(-angle)), np.sin(np.radians(-angle))
    cx, cy = (nw - 1) / 2, (nh - 1) / 2
    return out, np.array([[c, -s, (w - 1) / 2 - c * cx + s * cy], [s, c, (h - 1) / 2 - s * cx - c * cy], [0, 0, 1]])


def crops(img: np.ndarray, boxes: np.ndarray) -> list[np.ndarray]:
    """Straight crops of relative boxes: edges rounded half to even, the far one included."""
    h, w = img.shape[:2]
    px = np.rint(np.asarray(boxes, float).reshape(-1, 4) * [w, h, w, h]).astype(int)
    return [img[max(y0, 0) : y1 + 1, max(x0, 0) : x1 + 1] for x0, y0, x1, y1 in px]


def quad_crops(img: np.ndarray, quads: np.ndarray) -> list[np.ndarray]:
    """Upright crops of relative quads (top left, top right, bottom right, bottom left) by a projective map."""
    h, w = img.shape[:2]
    out = []
    for q in np.asarray(quads, float).reshape(-1, 4, 2) * [w, h]:
        nw, nh = (int(round(max(np.linalg.norm(q[a] - q[b]), np.linalg.norm(q[c] - q[d])))) for a, b, c, d in ((0, 1, 3, 2), (0, 3, 1, 2)))
        if nw < 1 or nh < 1:
            out.append(img[:0, :0])
            continue
        m = homography(np.array([(0, 0), (nw, 0), (nw, nh), (0, nh)], float), q)
        y, x = np.meshgrid(np.arange(nh), np.arange(nw), indexing="ij")
        p = np.stack([x, y, np.ones_like(x)], axis=-1) @ m.T
        out.append(np.rint(sampled(img, p[..., 0] / p[..., 2], p[..., 1] / p[..., 2])).astype(np.uint8))
    return out


def homography(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The projective map that takes four points to four others."""
    rows, right = [], []
    for (x, y), (u, v) in zip(a, b):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return np.append(np.linalg.solve(np.array(rows), np.array(right)), 1).reshape(3, 3)


def quarter_turned(parts: list[np.ndarray], turns: list[int]) -> list[np.ndarray]:
    """Crops turned upright by their predicted quarter turns."""
    return [np.rot90(p, -t) for p, t in zip(parts, turns)]


def inside(quad: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixels whose place lies in a convex polygon of pixel coordinates."""
    y, x = np.meshgrid(np.arange(height), np.arange(width), indexing="ij")
    side = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in zip(quad, np.roll(quad, -1, axis=0))]
    return np.all(np.array(side) >= 0, axis=0) | np.all(np.array(side) <= 0, axis=0)


def masked(img: np.ndarray, boxes: np.ndarray, fill: int = 255) -> np.ndarray:
    """Relative boxes (four numbers) or quads (eight) painted over."""
    out, (h, w) = img.copy(), img.shape[:2]
    for b in boxes:
        b = np.asarray(b, float).ravel()
        quad = b.reshape(-1, 2) if len(b) == 8 else b[[0, 1, 2, 1, 2, 3, 0, 3]].reshape(-1, 2)
        out[inside(quad * [w, h], h, w)] = fill
    return out


def components_of(bitmap: np.ndarray) -> np.ndarray:
    """Number of the connected part (four neighbours) of each set pixel, its least place; 0 elsewhere."""
    label = np.where(bitmap, np.arange(1, bitmap.size + 1).reshape(bitmap.shape), 0)
    while True:
        after = _spread(label)
        if (after == label).all():
            return label
        label = after


def _spread(label: np.ndarray) -> np.ndarray:
    """One round: each set pixel takes the least label among its neighbours', then labels lead to their own label."""
    low = label.copy()
    for a, b in ((np.s_[1:, :], np.s_[:-1, :]), (np.s_[:, 1:], np.s_[:, :-1])):
        both = (label[a] > 0) & (label[b] > 0)
        low[a] = np.where(both, np.minimum(low[a], label[b]), low[a])
        low[b] = np.where(both, np.minimum(low[b], label[a]), low[b])
    lead = np.arange(label.size + 1)
    np.minimum.at(lead, label.ravel(), low.ravel())
    while (lead[lead] != lead).any():
        lead = lead[lead]
    return np.where(label > 0, lead[low], 0)


def probability_boxes(probability: np.ndarray, threshold: float = 0.3, least_score: float = 0.1, least_side: int = 2, ratio: float = 1.5) -> np.ndarray:
    """Relative boxes and scores of the connected parts of a probability map.

    A part is kept if it is large enough and the mean probability in its box
    reaches the score; its box grows by area times ratio by circumference.
    """
    h, w = probability.shape
    label = components_of(probability >= threshold)
    out = []
    for part in np.unique(label[label > 0]):
        y, x = np.nonzero(label == part)
        x0, y0, x1, y1 = x.min(), y.min(), x.max(), y.max()
        if min(x1 - x0, y1 - y0) + 1 <= least_side:
            continue
        score = box_score(probability, np.array([x0, y0, x1, y1]))
        if score < least_score:
            continue
        grow = (x1 - x0 + 1) * (y1 - y0 + 1) * ratio / (2 * (x1 - x0 + y1 - y0 + 2))
        out.append([np.clip((x0 - grow) / w, 0, 1), np.clip((y0 - grow) / h, 0, 1), np.clip((x1 + 1 + grow) / w, 0, 1), np.clip((y1 + 1 + grow) / h, 0, 1), score])
    return np.array(out).reshape(-1, 5)


def box_score(probability: np.ndarray, points: np.ndarray) -> float:
    """Mean probability in a box (four numbers) or a convex polygon (pairs) of pixels."""
    h, w = probability.shape
    if points.ndim == 1:
        x0, y0, x1, y1 = (int(np.clip(v, 0, m - 1)) for v, m in zip((*np.floor(points[:2]), *np.ceil(points[2:])), (w, h, w, h)))
        return float(probability[y0 : y1 + 1, x0 : x1 + 1].mean())
    chosen = inside(points, h, w)
    return float(probability[chosen].mean()) if chosen.any() else 0.0


def page_skew(lines: list[tuple[float, float, float]], ratio: float = 3.0, most: int = 70) -> float:
    """Skew of a page in degrees from its parts (width, height, angle): the lower median of the longest elongated ones, 0 without any."""
    long = sorted(((w * h, a) for w, h, a in lines if max(w, h) / max(min(w, h), 1e-9) >= ratio), reverse=True)[:most]
    angles = sorted(a for _, a in long)
    return float(angles[(len(angles) - 1) // 2]) if angles else 0.0


# Augmentations: kernels for ``mapped``.


def inverted(least: float = 0.5) -> Kernel:
    """Colours turned round and scaled by a random factor for each channel."""
    return lambda img, rng: (255 - img) * (least + (1 - least) * rng.random((1, 1, 3)))


def noisy(mean: float = 0.0, std: float = 1.0) -> Kernel:
    return lambda img, rng: np.clip(img + 255 * (mean + 2 * std * (rng.random(img.shape) - 0.5)), 0, 255)


def blurred(low: float, high: float) -> Kernel:
    """Gaussian blur, along rows and then columns, with a random width."""

    def run(img: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        sigma = low + (high - low) * rng.random()
        k = np.arange(-3, 4)
        weight = np.exp(-(k**2) / (2 * max(sigma, 1e-6) ** 2))
        out = img.astype(float)
        for axis in (0, 1):
            edge = np.pad(out, [(3, 3) if a == axis else (0, 0) for a in range(3)], mode="edge")
            out = sum(wt * np.take(edge, np.arange(out.shape[axis]) + i, axis=axis) for i, wt in enumerate(weight / weight.sum()))
        return np.rint(out)

    return run


def shuffled() -> Kernel:
    return lambda img, rng: img[..., rng.permutation(3)]


def mirrored(share: float = 0.5) -> Kernel:
    return lambda img, rng: img[:, ::-1] if rng.random() < share else img


def shadowed(low: float = 0.2, high: float = 0.8) -> Kernel:
    """A random triangle from one edge, darkened."""

    def run(img: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        h, w = img.shape[:2]
        base = np.sort(rng.random(2)) * w
        shape = inside(np.array([(base[0], 0), (max(base[1], base[0] + 0.3 * w), 0), (rng.random() * w, h * (0.3 + 0.7 * rng.random()))]), h, w)
        if rng.random() < 0.5:
            shape = shape[::-1]
        return np.where(shape[..., None], img * (1 - (low + (high - low) * rng.random())), img)

    return run


def window(scale: tuple[float, float] = (0.08, 1.0), ratio: tuple[float, float] = (0.75, 1.33)) -> Callable[[int, int, np.random.Generator], tuple[int, int, int, int]]:
    """A random window of the page; targets are cut to it by ``geometry.crop``."""

    def run(h: int, w: int, rng: np.random.Generator) -> tuple[int, int, int, int]:
        area, r = h * w * rng.uniform(*scale), rng.uniform(*ratio)
        nw, nh = min(w, max(1, round((area * r) ** 0.5))), min(h, max(1, round((area / r) ** 0.5)))
        x, y = int(rng.integers(0, w - nw + 1)), int(rng.integers(0, h - nh + 1))
        return x, y, x + nw, y + nh

    return run


def resized(low: float = 0.3, high: float = 0.9, share: float = 0.5) -> Kernel:
    """A random scale of each side, with a probability."""
    return lambda img, rng: stretched(img, max(1, int(img.shape[0] * rng.uniform(low, high))), max(1, int(img.shape[1] * rng.uniform(low, high)))) if rng.random() < share else img


def spun(most: float = 5.0, expand: bool = False) -> Kernel:
    return lambda img, rng: turned(img, rng.uniform(-most, most), expand)


def sequence(*kernels: Kernel) -> Kernel:
    """One kernel after the other."""

    def run(img: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        for k in kernels:
            img = np.asarray(k(img, rng)).astype(np.uint8)
        return img

    return run


def one_of(*kernels: Kernel) -> Kernel:
    return lambda img, rng: kernels[int(rng.integers(len(kernels)))](img, rng)


def sometimes(kernel: Kernel, share: float = 0.5) -> Kernel:
    return lambda img, rng: kernel(img, rng) if rng.random() < share else img
