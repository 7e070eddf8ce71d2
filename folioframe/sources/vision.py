"""Image operators on numpy arrays, run on rows of images by mapInPandas, and the OCR adapter.

They follow the same steps as common image libraries in numpy alone; pixel for pixel agreement isn't claimed.
"""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def otsu(gray: np.ndarray) -> int:
    """The threshold that parts dark from light with the greatest variance between them."""
    p = np.bincount(gray.ravel(), minlength=256) / gray.size
    w, m = p.cumsum(), (p * np.arange(256)).cumsum()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (m[-1] * w - m) ** 2 / (w * (1 - w))
    return int(np.nanargmax(np.where(np.isfinite(between), between, np.nan))) if np.isfinite(between).any() else 127


def box_mean(gray: np.ndarray, size: int) -> np.ndarray:
    """Mean around each pixel, from an integral image, edges repeated."""
    r = size // 2
    s = np.pad(gray.astype(np.float64), r, mode="edge").cumsum(0).cumsum(1)
    s = np.pad(s, ((1, 0), (1, 0)))
    h, w = gray.shape
    n = 2 * r + 1
    return (s[n : n + h, n : n + w] - s[:h, n : n + w] - s[n : n + h, :w] + s[:h, :w]) / n**2


def ink(gray: np.ndarray, size: int = 41, offset: int = 15) -> np.ndarray:
    """True where a pixel is darker than its surroundings by an offset."""
    return gray < box_mean(gray, size) - offset


def runs(mask: np.ndarray, gap: int = 1) -> list[tuple[int, int]]:
    """First and last place of each group of true places that are at most gap apart."""
    at = np.flatnonzero(mask)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > gap)
    return list(zip(at[np.r_[0, cut + 1]].tolist(), at[np.r_[cut, len(at) - 1]].tolist(), strict=True))


def vertical_rules(dark: np.ndarray, share: float = 0.45, gap: int = 2, close: int = 20) -> list[int]:
    """Centers of columns that are dark over a share of the height, close ones averaged."""
    out: list[int] = []
    for a, b in runs(dark.mean(0) >= share, gap):
        x = (a + b) // 2
        if out and x - out[-1] <= close:
            out[-1] = (out[-1] + x) // 2
        else:
            out.append(x)
    return out


def gutter(gray: np.ndarray) -> int:
    """The column between two facing pages: dark, unlike its neighbours, without ink and near the middle."""
    h, w = gray.shape
    lo, hi = int(w * 0.45), int(w * 0.55)
    column = gray.mean(0)
    smooth = np.convolve(np.pad(column, 15, mode="edge"), np.ones(31) / 31, "valid")
    marks = ink(gray).mean(0)
    scaled = lambda x: (x - x.min()) / (np.ptp(x) or 1)
    at = np.arange(lo, hi)
    score = 0.45 * scaled(255 - column)[at] + 0.20 * scaled(np.abs(column - smooth))[at] + 0.35 * (1 - scaled(marks)[at]) - 0.40 * np.abs(at - w / 2) / (0.05 * w or 1)
    return int(at[score.argmax()]) if len(at) else w // 2


def halves(gray: np.ndarray, overlap: int = 40) -> dict[str, tuple[int, int]]:
    """Columns of the left and right page, both a bit over the gutter."""
    g, w = gutter(gray), gray.shape[1]
    return {"left": (0, min(w, g + overlap)), "right": (max(0, g - overlap), w)}


def content_box(gray: np.ndarray, pad: int = 10) -> tuple[int, int, int, int]:
    """Box of the light page on a dark ground."""
    page = gray > otsu(gray)
    rows, cols = np.flatnonzero(page.mean(1) > 0.2), np.flatnonzero(page.mean(0) > 0.2)
    if not len(rows) or not len(cols):
        return 0, 0, gray.shape[1], gray.shape[0]
    return max(0, cols[0] - pad), max(0, rows[0] - pad), min(gray.shape[1], cols[-1] + 1 + pad), min(gray.shape[0], rows[-1] + 1 + pad)


def table_zone(gray: np.ndarray) -> tuple[int, int, int, int]:
    """Box of the densest part of a page: rows and columns with ink, small gaps closed."""
    dark = ink(gray)
    rows, cols = runs(dark.mean(1) > 0.02, 24), runs(dark.mean(0) > 0.02, 24)
    if not rows or not cols:
        return 0, 0, gray.shape[1], gray.shape[0]
    (y0, y1), (x0, x1) = max(rows, key=lambda r: r[1] - r[0]), max(cols, key=lambda r: r[1] - r[0])
    return x0, y0, x1 + 1, y1 + 1


def without_rules(gray: np.ndarray, length: int = 60) -> np.ndarray:
    """The page with long straight lines painted white."""
    dark, out = ink(gray), gray.copy()
    for axis in (0, 1):
        lines = dark if axis else dark.T
        target = out if axis else out.T
        for y in range(lines.shape[0]):
            for a, b in runs(lines[y]):
                if b - a + 1 >= length:
                    target[y, a : b + 1] = 255
    return out


def measures(gray: np.ndarray) -> dict[str, float]:
    """Shares and means that the manifest holds."""
    x0, y0, x1, y1 = content_box(gray)
    dark = ink(gray)
    return {"content_ratio": (x1 - x0) * (y1 - y0) / gray.size, "mean_gray": float(gray.mean()), "dark_ratio": float(dark.mean()), "horizontal_line_score": float((dark.mean(1) > 0.45).mean()), "vertical_line_score": float((dark.mean(0) > 0.45).mean())}


def pixels(row) -> np.ndarray:
    """Gray pixels of a row of Spark's image source."""
    data = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], -1)
    return (data[:, :, :3] @ np.array([0.114, 0.587, 0.299]) if data.shape[2] >= 3 else data[:, :, 0]).round().astype(np.uint8)


def page_measures(images: DataFrame) -> DataFrame:
    """origin and measures of images (column image); a page that can't be read has an error instead."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for image in f["image"]:
                try:
                    out.append({"origin": image["origin"], **measures(pixels(image)), "error": None})
                except Exception as e:  # one bad page doesn't stop the others
                    out.append({"origin": image["origin"], "error": str(e)})
            yield pd.DataFrame(out, columns=["origin", "content_ratio", "mean_gray", "dark_ratio", "horizontal_line_score", "vertical_line_score", "error"])

    return images.mapInPandas(each, "origin string, content_ratio double, mean_gray double, dark_ratio double, horizontal_line_score double, vertical_line_score double, error string")


def tesseract(image_path: str, psm: str, lang: str = "ita+eng", run: Callable = subprocess.run) -> str:
    """Words of an image as the OCR engine prints them; '' where the engine isn't installed."""
    if shutil.which("tesseract") is None:
        return ""
    return run(["tesseract", image_path, "stdout", "--oem", "1", "--psm", psm, "-l", lang, "tsv"], capture_output=True, text=True, check=True).stdout
