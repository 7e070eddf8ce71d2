"""Page images in numpy: filters, thresholds, components, geometry and a plain PNG writer.

Arrays are gray (uint8) or masks (bool). Windows at the edges repeat the edge's pixels unless said otherwise. All take time
linear in the pixels, whatever the window's size, but for the perspective search and the Hough accumulator, which take
time linear in the outline's and the ink's pixels.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from folioframe.sources.vision import otsu


def _extreme(a: np.ndarray, size: int, axis: int, f) -> np.ndarray:
    """Sliding f (np.minimum or np.maximum) over size places around each: running extremes of blocks from both sides."""
    a = np.moveaxis(a, axis, -1)
    n, r = a.shape[-1], size // 2
    fill = np.iinfo(a.dtype).max if f is np.minimum else np.iinfo(a.dtype).min
    blocks = -(-(n + 2 * r) // size)
    p = np.full((*a.shape[:-1], blocks * size), fill, a.dtype)
    p[..., r : r + n] = a
    b = p.reshape(*a.shape[:-1], blocks, size)
    ahead = f.accumulate(b, -1).reshape(p.shape)
    behind = f.accumulate(b[..., ::-1], -1)[..., ::-1].reshape(p.shape)
    return np.moveaxis(f(behind[..., :n], ahead[..., size - 1 : size - 1 + n]), -1, axis)


def eroded(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """The least value in a window around each pixel (odd sizes); beyond the image nothing counts."""
    return _extreme(_extreme(a.astype(np.uint8), height, 0, np.minimum), width, 1, np.minimum)


def dilated(a: np.ndarray, height: int, width: int) -> np.ndarray:
    return _extreme(_extreme(a.astype(np.uint8), height, 0, np.maximum), width, 1, np.maximum)


def opened(a: np.ndarray, height: int, width: int) -> np.ndarray:
    return dilated(eroded(a, height, width), height, width)


def closed(a: np.ndarray, height: int, width: int) -> np.ndarray:
    return eroded(dilated(a, height, width), height, width)


def gaussian(a: np.ndarray, size: int, sigma: float | None = None) -> np.ndarray:
    """Gaussian mean over an odd window, one axis after the other; sigma follows from the size as 0.3 ((size - 1) / 2 - 1) + 0.8."""
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    k /= k.sum()
    out = a.astype(np.float64)
    for axis in (0, 1):
        p = np.pad(out, [(size // 2,) * 2 if x == axis else (0, 0) for x in (0, 1)], mode="edge")
        n = out.shape[axis]
        out = sum(w * np.take(p, range(j, j + n), axis) for j, w in enumerate(k))
    return out


def equalised(gray: np.ndarray) -> np.ndarray:
    """Gray values spread so that each share of the pixels gets its share of the range."""
    counts = np.bincount(gray.ravel(), minlength=256)
    first = int(np.flatnonzero(counts)[0])
    rest = gray.size - counts[first]
    if not rest:
        return gray.copy()
    table = np.clip(np.round((counts.cumsum() - counts[first]) * (255 / rest)), 0, 255).astype(np.uint8)
    return table[gray]


def adaptive_ink(gray: np.ndarray, size: int = 41, offset: int = 15) -> np.ndarray:
    """True where an equalised pixel is darker than the gaussian mean around it by an offset."""
    even = equalised(gray)
    return even <= np.round(gaussian(even, size)) - offset


def page_mask(gray: np.ndarray, size: int = 35) -> np.ndarray:
    """True on paper: light by Otsu's threshold after a blur, gaps closed and specks opened."""
    soft = np.round(gaussian(gray, 7)).astype(np.uint8)
    light = soft > otsu(soft)
    return opened(closed(light, size, size), size, size).astype(bool)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end (exclusive) of each horizontal run of true pixels."""
    p = np.zeros((mask.shape[0], mask.shape[1] + 2), np.int8)
    p[:, 1:-1] = mask
    step = np.diff(p, axis=1)
    row, start = np.nonzero(step == 1)
    return row, start, np.nonzero(step == -1)[1]


def components(mask: np.ndarray) -> np.ndarray:
    """x0, y0, x1, y1 (exclusive) and area of each 8-connected component, by its first pixel in reading order.

    Runs of neighbouring rows that touch are joined: each run's partners stand together in the sorted row before, and a
    union of all such pairs gives the components.
    """
    row, start, end = _runs(mask)
    n = len(row)
    if not n:
        return np.empty((0, 5), np.int64)
    width = mask.shape[1] + 2
    low = np.searchsorted(row * width + end, (row - 1) * width + start)  # the first run above that ends at start or later
    high = np.searchsorted(row * width + start, (row - 1) * width + end, side="right")  # and after the last that starts at end or before
    times = np.maximum(high - low, 0)
    x = np.repeat(np.arange(n), times)
    y = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
    root = np.arange(n)
    while len(x):
        x, y = root[x], root[y]
        least, new = np.minimum(x, y), root.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        while ((further := new[new]) != new).any():
            new = further
        if (new == root).all():
            break
        root = new
    names, at = np.unique(root, return_inverse=True)
    m, big = len(names), np.iinfo(np.int64).max
    out = np.stack([np.full(m, big), np.full(m, big), np.zeros(m, np.int64), np.zeros(m, np.int64), np.bincount(at, end - start, m).astype(np.int64)], 1)
    np.minimum.at(out[:, 0], at, start)
    np.minimum.at(out[:, 1], at, row)
    np.maximum.at(out[:, 2], at, end)
    np.maximum.at(out[:, 3], at, row + 1)
    return out


def line_metrics(gray: np.ndarray) -> tuple[float, float, int]:
    """Shares of pixels on long horizontal and vertical lines, and how many components the rest of the ink has, without specks
    and blots."""
    dark = adaptive_ink(gray)
    h, w = dark.shape
    flat, upright = (opened(dark, 1, max(30, w // 18) | 1).astype(bool), opened(dark, max(30, h // 18) | 1, 1).astype(bool))
    c = components(dark & ~flat & ~upright)
    wide, high, area = c[:, 2] - c[:, 0], c[:, 3] - c[:, 1], c[:, 4]
    kept = (area >= 5) & (area <= h * w * 0.01) & (wide <= w * 0.35) & (high <= h * 0.08)
    return float(flat.mean()), float(upright.mean()), int(kept.sum())


def local_contrast(gray: np.ndarray, tiles: int = 8, clip: float = 2.0) -> np.ndarray:
    """Each tile's histogram is cut at a multiple of its mean, what is cut spread over all values, and equalised; a pixel takes
    the mean of the four nearest tiles' maps by its distance from their centers."""
    h, w = gray.shape
    th, tw = -(-h // tiles), -(-w // tiles)
    p = np.pad(gray, ((0, th * tiles - h), (0, tw * tiles - w)), mode="symmetric" if min(h, w) > tiles else "edge")
    t = p.reshape(tiles, th, tiles, tw).swapaxes(1, 2).reshape(tiles * tiles, -1)
    counts = np.stack([np.bincount(x, minlength=256) for x in t])
    limit = max(1, int(clip * th * tw / 256))
    over = np.maximum(counts - limit, 0).sum(1)
    counts = np.minimum(counts, limit) + over[:, None] // 256
    left = over % 256
    counts += (np.arange(256)[None, :] * left[:, None] // 256 != (np.arange(256)[None, :] + 1) * left[:, None] // 256).astype(counts.dtype)
    maps = np.clip(np.round(counts.cumsum(1) * (255 / (th * tw))), 0, 255).reshape(tiles, tiles, 256)

    def near(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.arange(n) + 0.5) / size - 0.5
        low = np.clip(np.floor(at).astype(int), 0, tiles - 1)
        high = np.clip(np.floor(at).astype(int) + 1, 0, tiles - 1)
        return low, high, at - np.floor(at)

    (ya, yb, fy), (xa, xb, fx) = near(h, th), near(w, tw)
    value = lambda y, x: maps[y[:, None], x[None, :], gray]
    top = value(ya, xa) * (1 - fx) + value(ya, xb) * fx
    low = value(yb, xa) * (1 - fx) + value(yb, xb) * fx
    return np.round(top * (1 - fy[:, None]) + low * fy[:, None]).astype(np.uint8)


def without_shading(gray: np.ndarray) -> np.ndarray:
    """The page with slow changes of the background divided out and local contrast raised."""
    size = max(51, (min(gray.shape) // 18) | 1)
    ground = np.maximum(np.round(gaussian(gray, size)), 1)
    return local_contrast(np.clip(np.round(gray * (245 / ground)), 0, 255).astype(np.uint8))


def sampled(gray: np.ndarray, x: np.ndarray, y: np.ndarray, fill: int) -> np.ndarray:
    """Bilinear values at places (arrays of one shape); fill beyond the image."""
    h, w = gray.shape
    out = (x < -0.5) | (y < -0.5) | (x > w - 0.5) | (y > h - 0.5)
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    x1, y1 = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1)
    fx, fy = x - x0, y - y0
    g = gray.astype(np.float64)
    v = (g[y0, x0] * (1 - fx) + g[y0, x1] * fx) * (1 - fy) + (g[y1, x0] * (1 - fx) + g[y1, x1] * fx) * fy
    return np.where(out, fill, np.round(v)).astype(np.uint8)


def rotated(gray: np.ndarray, degrees: float, fill: int = 245) -> np.ndarray:
    """The image turned counter-clockwise about its center, on a sheet that holds all of it."""
    h, w = gray.shape
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    nh, nw = int(h * abs(c) + w * abs(s)), int(h * abs(s) + w * abs(c))
    y, x = np.mgrid[:nh, :nw].astype(np.float64)
    x, y = x - nw / 2, y - nh / 2
    return sampled(gray, c * x - s * y + w / 2, s * x + c * y + h / 2, fill)


def outline(mask: np.ndarray) -> np.ndarray:
    """The convex hull (x, y) of the largest component, clockwise as seen on the page."""
    c = components(mask)
    if not len(c):
        return np.empty((0, 2))
    x0, y0, x1, y1, _ = c[c[:, 4].argmax()]
    part = mask[y0:y1, x0:x1]
    rows = np.flatnonzero(part.any(1))
    left, right = part.argmax(1)[rows], part.shape[1] - 1 - part[:, ::-1].argmax(1)[rows]
    points = np.unique(np.concatenate([np.stack([left + x0, rows + y0], 1), np.stack([right + x0, rows + y0], 1)]), axis=0)

    def half(points: np.ndarray) -> list:
        out: list = []
        for p in points.tolist():
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(points) + half(points[::-1]), np.float64)


def corners(hull: np.ndarray) -> np.ndarray | None:
    """The hull's four corners from the top left, clockwise: edges are given up, the one first that costs least area, its
    neighbours being drawn out until they meet. None if four don't remain."""
    p = hull.copy()
    while len(p) > 4:
        a, b, c, d = np.roll(p, 1, 0), p, np.roll(p, -1, 0), np.roll(p, -2, 0)  # edge b-c goes; a-b and d-c meet
        u, v, w = b - a, c - d, c - b
        cross = u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (w[:, 0] * v[:, 1] - w[:, 1] * v[:, 0]) / cross
            s = (w[:, 0] * u[:, 1] - w[:, 1] * u[:, 0]) / cross
            meet = b + u * t[:, None]
            cost = np.abs(w[:, 0] * (meet - b)[:, 1] - w[:, 1] * (meet - b)[:, 0])
        cost = np.where((t >= 0) & (s >= 0) & np.isfinite(cost), cost, np.inf)
        k = int(cost.argmin())
        if not np.isfinite(cost[k]):
            return None
        p[k] = meet[k]
        p = np.delete(p, (k + 1) % len(p), 0)
    if len(p) != 4:
        return None
    total, apart = p.sum(1), p[:, 1] - p[:, 0]
    return p[[total.argmin(), apart.argmin(), total.argmax(), apart.argmax()]]


def homography(to: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The matrix that takes four points to four others."""
    rows = []
    for (x, y), (u, v) in zip(to, of, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
    return np.append(np.linalg.solve(np.array(rows, float), np.asarray(of, float).ravel()), 1).reshape(3, 3)


def straightened(gray: np.ndarray, least: tuple[int, int] = (500, 800), share: float = 0.45, size: int = 35) -> tuple[np.ndarray, bool]:
    """The page between its four corners as a rectangle, and whether it has been; else the image as it is, if the paper fills less
    than a share of it, has no four corners or would be smaller than the least width and height."""
    mask = page_mask(gray, size)
    hull = outline(mask)
    if len(hull) < 4 or 2 * share * gray.size > abs(np.dot(hull[:, 0], np.roll(hull[:, 1], -1)) - np.dot(hull[:, 1], np.roll(hull[:, 0], -1))):
        return gray, False
    four = corners(hull)
    if four is None:
        return gray, False
    tl, tr, br, bl = four
    far = lambda a, b: float(np.hypot(*(a - b)))
    w, h = int(max(far(br, bl), far(tr, tl))), int(max(far(tr, br), far(tl, bl)))
    if w < least[0] or h < least[1]:
        return gray, False
    m = homography(np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]]), four)
    y, x = np.mgrid[:h, :w].astype(np.float64)
    z = m[2, 0] * x + m[2, 1] * y + 1
    return sampled(gray, (m[0, 0] * x + m[0, 1] * y + m[0, 2]) / z, (m[1, 0] * x + m[1, 1] * y + m[1, 2]) / z, 0), True


def slant(gray: np.ndarray, most: float = 8.0, step: float = 0.25, share: float = 0.3) -> float:
    """The median angle in degrees of the long lines: cells of a Hough accumulator with ink over a share of the width count, one
    line for each place; 0 without any. Falling lines are positive."""
    dark = adaptive_ink(gray)
    y, x = np.nonzero(dark & ~np.roll(dark, 1, 0))  # upper edges of the ink
    if not len(y):
        return 0.0
    found: list[tuple[int, float]] = []
    for a in np.arange(-most, most + step / 2, step):
        at = np.round(y - np.tan(np.radians(a)) * x).astype(int)
        counts = np.bincount(at - at.min())
        strong = np.flatnonzero(counts >= share * gray.shape[1])
        found += [(int(counts[k]), float(a)) for k in strong]
    if not found:
        return 0.0
    best = max(c for c, _ in found)
    return float(np.median([a for c, a in found if c >= 0.8 * best]))


def deskewed(gray: np.ndarray) -> tuple[np.ndarray, float]:
    """The page with its lines level, and the angle by which it was turned."""
    angle = slant(gray)
    return (rotated(gray, angle), angle) if abs(angle) >= 0.1 else (gray, 0.0)


def strip(gray: np.ndarray, scale: int = 3) -> np.ndarray:
    """A strip of figures as it is read again: larger, equalised, dark on white by its surroundings."""
    h, w = gray.shape
    y, x = np.mgrid[: h * scale, : w * scale].astype(np.float64)
    large = sampled(gray, (x + 0.5) / scale - 0.5, (y + 0.5) / scale - 0.5, 255)
    return np.where(adaptive_ink(large, 35, 11), 0, 255).astype(np.uint8)


def overlay(gray: np.ndarray, rows: list[tuple[int, int, int, int]], edges: list[int], rules: list[int]) -> np.ndarray:
    """The page with the frames of its rows (left, top, right, bottom), its columns' edges and the rules that were found."""
    out = gray.copy()
    h, w = out.shape
    for x, value in [*((r, 220) for r in rules), *((e, 180) for e in edges)]:
        if 0 <= x < w:
            out[:, x] = value
    for x0, y0, x1, y1 in rows:
        x0, y0, x1, y1 = max(0, x0), max(0, y0), min(w, x1), min(h, y1)
        for part in (np.s_[y0 : y0 + 2, x0:x1], np.s_[max(y0, y1 - 2) : y1, x0:x1], np.s_[y0:y1, x0 : x0 + 2], np.s_[y0:y1, max(x0, x1 - 2) : x1]):
            out[part] = 90
    return out


def png(gray: np.ndarray) -> bytes:
    """A gray image as PNG."""
    h, w = gray.shape
    raw = np.zeros((h, w + 1), np.uint8)
    raw[:, 1:] = gray
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw.tobytes())) + part(b"IEND", b"")
