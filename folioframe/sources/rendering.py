"""Images of pages drawn from their words, and what is measured on them, page by page."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.sources import imaging


def rendered(words: DataFrame, wide: int = 10) -> DataFrame:
    """page, boxes: the words of each page as boxes, wide places of the page to a pixel across and one down."""
    box = F.array((F.col("left_") / wide).cast("int"), F.col("top"), (F.col("right_") / wide).cast("int"), F.col("bottom"))
    return words.groupBy("page").agg(F.flatten(F.collect_list(box)).alias("boxes"))


def drawn(boxes: np.ndarray) -> np.ndarray:
    """A mask of boxes (x0, y0, x1, y1 in a row each), as high and wide as they reach."""
    b = np.asarray(boxes, np.int64).reshape(-1, 4)
    mask = np.zeros((b[:, 3].max(initial=0), b[:, 2].max(initial=0)), bool)
    for x0, y0, x1, y1 in b.tolist():
        mask[y0:y1, x0:x1] = True
    return mask


def strips(boxes: np.ndarray) -> Iterator[np.ndarray]:
    """The boxes in groups with an empty row of pixels between them, so that no component has parts of two."""
    b = np.asarray(boxes, np.int64).reshape(-1, 4)
    b = b[(b[:, 2] > b[:, 0]) & (b[:, 3] > b[:, 1])]
    b = b[np.argsort(b[:, 1], kind="stable")]
    reach = np.maximum.accumulate(b[:, 3])
    yield from np.split(b, np.flatnonzero(b[1:, 1] > reach[:-1]) + 1) if len(b) else ()


def measured(boxes: np.ndarray) -> tuple[int, int, int, int, int, int]:
    """Number, ink and bounds (x0, x1, y0, y1) of the components of a page's image, of which one strip at a time is drawn: a
    whole one has as many pixels as its longest line times its height."""
    out = []
    for b in strips(boxes):
        x, y = b[:, 0].min(), b[:, 1].min()
        c = imaging.components(drawn(b - np.array([x, y, x, y])))
        out.append((len(c), c[:, 4].sum(), c[:, 0].min() + x, c[:, 2].max() + x, c[:, 1].min() + y, c[:, 3].max() + y))
    n, ink, x0, x1, y0, y1 = np.array(out, np.int64).T
    return n.sum(), ink.sum(), x0.min(), x1.max(), y0.min(), y1.max()


def components_of(pages: DataFrame) -> DataFrame:
    """Number, ink and bounds of the connected components of each page's image."""

    def each(frames):
        for f in frames:
            out = [(page, *measured(boxes)) for page, boxes in zip(f["page"], f["boxes"], strict=True)]
            yield pd.DataFrame(out, columns=["page", "n_components", "ink", "x0", "x1", "y0", "y1"])

    return pages.mapInPandas(each, "page bigint, n_components bigint, ink bigint, x0 int, x1 int, y0 int, y1 int")
