"""Image operators against brute force on small arrays, and on rendered pages."""

import struct
import zlib

import numpy as np
import pytest

from folioframe.sources import imaging as I


def rng(seed):
    return np.random.default_rng(seed)


def window(a, h, w, f, fill):
    p = np.full((a.shape[0] + h - 1, a.shape[1] + w - 1), fill, a.dtype)
    p[h // 2 : h // 2 + a.shape[0], w // 2 : w // 2 + a.shape[1]] = a
    return np.array([[f(p[i : i + h, j : j + w]) for j in range(a.shape[1])] for i in range(a.shape[0])])


@pytest.mark.parametrize("h,w", [(1, 1), (3, 5), (1, 9), (7, 1), (35, 35)])
def test_morphology_equals_windows(h, w):
    a = rng(h * w).integers(0, 256, (23, 31)).astype(np.uint8)
    assert (I.eroded(a, h, w) == window(a, h, w, np.min, 255)).all()
    assert (I.dilated(a, h, w) == window(a, h, w, np.max, 0)).all()
    assert (I.opened(a, h, w) == window(window(a, h, w, np.min, 255), h, w, np.max, 0)).all()


def test_gaussian_and_adaptive_ink_equal_windows():
    a = rng(1).integers(0, 256, (20, 25)).astype(np.uint8)
    for size in (3, 7, 11):
        sigma = 0.3 * ((size - 1) / 2 - 1) + 0.8
        k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
        k = np.outer(k, k) / k.sum() ** 2
        p = np.pad(a.astype(float), size // 2, mode="edge")
        want = np.array([[(p[i : i + size, j : j + size] * k).sum() for j in range(25)] for i in range(20)])
        assert np.allclose(I.gaussian(a, size), want)
    even = I.equalised(a)
    assert even.min() == 0 and even.max() == 255 and (np.diff(even.ravel()[np.argsort(a.ravel())].astype(int)) >= 0).all()
    assert (I.adaptive_ink(a, 7, 15) == (even <= np.round(I.gaussian(even, 7)) - 15)).all()
    flat = np.full((9, 9), 7, np.uint8)
    assert (I.equalised(flat) == 7).all() and not I.adaptive_ink(flat).any()


def flood(mask):
    seen, out = np.zeros(mask.shape, bool), []
    for i, j in zip(*np.nonzero(mask)):
        if seen[i, j]:
            continue
        stack, cells = [(i, j)], []
        seen[i, j] = True
        while stack:
            y, x = stack.pop()
            cells.append((y, x))
            for v in range(max(0, y - 1), min(mask.shape[0], y + 2)):
                for u in range(max(0, x - 1), min(mask.shape[1], x + 2)):
                    if mask[v, u] and not seen[v, u]:
                        seen[v, u] = True
                        stack.append((v, u))
        ys, xs = zip(*cells)
        out.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1, len(cells)))
    return out


@pytest.mark.parametrize("share", [0.0, 0.1, 0.35, 0.5, 0.8, 1.0])
def test_components_equal_a_flood_fill(share):
    for seed in range(6):
        mask = rng(seed).random((24, 37)) < share
        assert [tuple(r) for r in I.components(mask)] == flood(mask)
    spiral = np.zeros((21, 21), bool)
    spiral[::2], spiral[:, 0], spiral[1::4, -1], spiral[3::4, 0] = True, False, True, True
    assert [tuple(r) for r in I.components(spiral)] == flood(spiral)


def test_local_contrast_is_even_and_monotone_on_a_tile():
    flat = np.full((64, 64), 100, np.uint8)
    assert np.ptp(I.local_contrast(flat)) == 0
    soft = np.clip(rng(4).normal(120, 4, (160, 160)), 0, 255).astype(np.uint8)
    assert I.local_contrast(soft).std() > 2 * soft.std()
    shade = (np.linspace(120, 240, 200)[None, :] * np.ones((120, 1))).astype(np.uint8)
    shade[40:44, 20:180] //= 3
    level = I.without_shading(shade)
    assert abs(level[10:30, :40].mean() - level[10:30, -40:].mean()) < 30 and level[42, 100] < level[10:30].mean() - 60


def page(h=300, w=200):
    out = np.full((h, w), 240, np.uint8)
    for k in range(12):
        out[20 + 22 * k : 24 + 22 * k, 20 : w - 20] = 20
    return out


def test_perspective_comes_back_within_a_pixel():
    sheet, four = page(), np.array([[30, 25], [262, 40], [250, 370], [22, 355]], float)
    m = I.homography(four, np.array([[0, 0], [199, 0], [199, 299], [0, 299]]))
    y, x = np.mgrid[:400, :290].astype(float)
    z = m[2, 0] * x + m[2, 1] * y + 1
    seen = I.sampled(sheet, (m[0, 0] * x + m[0, 1] * y + m[0, 2]) / z, (m[1, 0] * x + m[1, 1] * y + m[1, 2]) / z, 10)
    found = I.corners(I.outline(I.page_mask(seen, 9)))
    assert np.abs(found - four).max() < 2.5
    back, done = I.straightened(seen, least=(100, 100), size=9)
    assert done and abs(back.shape[1] - 232) <= 4 and abs(back.shape[0] - 331) <= 4
    dark = np.flatnonzero((back < 128).mean(1) > 0.5)
    want = (np.arange(12) * 22 + 21.5) * (back.shape[0] - 1) / 299
    assert all(np.abs(dark - y).min() <= 2 for y in want)
    assert I.straightened(np.full((50, 50), 9, np.uint8))[1] is False


@pytest.mark.parametrize("angle", [-3.0, -0.75, 0.0, 1.5, 4.0])
def test_slant_is_found_and_taken_out(angle):
    seen = I.rotated(page(), -angle)
    assert abs(I.slant(seen) - angle) <= 0.5
    level, turned = I.deskewed(seen)
    assert abs(I.slant(level)) <= 0.5 and (turned == 0 or abs(turned - angle) <= 0.5)


def test_lines_and_components_of_a_page():
    sheet = np.full((400, 300), 230, np.uint8)
    sheet[50:52, 20:280] = sheet[20:380, 150:152] = 10
    for k in range(5):
        sheet[100:108, 20 + 22 * k : 30 + 22 * k] = 10
    flat, upright, n = I.line_metrics(sheet)
    assert flat > 0.002 and upright > 0.002 and n >= 5


def test_png_holds_the_pixels():
    a = rng(2).integers(0, 256, (5, 7)).astype(np.uint8)
    data = I.png(a)
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", data[16:24]) == (7, 5)
    size = struct.unpack(">I", data[33:37])[0]
    rows = np.frombuffer(zlib.decompress(data[41 : 41 + size]), np.uint8).reshape(5, 8)
    assert (rows[:, 0] == 0).all() and (rows[:, 1:] == a).all()


def test_strips_and_overlays():
    gray = np.full((20, 60), 200, np.uint8)
    gray[6:14, 10:14] = 40
    large = I.strip(gray)
    assert large.shape == (60, 180) and set(np.unique(large)) <= {0, 255} and (large[20:40, 32:40] == 0).mean() > 0.9 and (large[:, 100:] == 255).all()
    seen = I.overlay(gray, [(5, 4, 30, 16), (50, -3, 90, 5)], [20, 500], [40])
    assert (seen[4:6, 5:30] == 90).all() and (seen[17:, 20] == 180).all() and (seen[:, 40] == 220).all() and (seen[0, 50:] == 90).all() and (seen[7:13, 11:13] == 40).all()


def test_a_page_is_drawn_in_strips_of_bounded_size(monkeypatch):
    """Against the whole image; one long line must not make every line of its page as wide."""
    from folioframe.sources import rendering as R

    r, sizes = rng(4), []
    for k in range(30):
        at = r.integers(0, 60, (40, 2)) * [1, 1 + k % 4]
        boxes = np.concatenate([at, at + r.integers(1, 9, (40, 2))], 1)
        c = I.components(R.drawn(boxes))
        assert R.measured(boxes.ravel()) == (len(c), c[:, 4].sum(), c[:, 0].min(), c[:, 2].max(), c[:, 1].min(), c[:, 3].max())
    whole = R.drawn
    monkeypatch.setattr(R, "drawn", lambda b: (lambda m: sizes.append(m.size) or m)(whole(b)))
    lines = [(0, 40 * k, 9000 if k == 70 else 50, 40 * k + 24) for k in range(1, 200)]
    assert R.measured(np.array(lines)) == (199, 24 * (9000 + 198 * 50), 0, 9000, 40, 40 * 199 + 24)
    assert max(sizes) <= 24 * 9000
