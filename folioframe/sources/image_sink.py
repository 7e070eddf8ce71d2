"""Image files written from a table, once each, whatever tasks are repeated.

format("page_images") takes rows of name and content (bytes). A task writes its files under draft names of its own
attempt; at the commit of the job the drafts get their names, and a manifest lists them; a failed job's drafts go. A name
that two rows share is an error, and so is a name that isn't a plain relative path. save mode append adds files and
replaces those of equal names, overwrite takes away the files of the manifest first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from folioframe.sources.imaging import png

MANIFEST = "_images.json"


def _at(path: str):
    from pyarrow.fs import FileSystem

    if "://" not in path and ":" in path.split("/")[0]:
        path = path.replace(":", "://", 1)  # file:/a as the cluster's readers write it
    return FileSystem.from_uri(path if "://" in path else f"file://{path}")


@dataclass
class Drafts(WriterCommitMessage):
    """What a task has written: names and the paths of their drafts."""

    files: list[tuple[str, str]]


class ImageWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Drafts:
        fs, base = _at(self.path)
        out = []
        for row in iterator:
            name = row["name"]
            if not name or name.startswith(("/", "_", ".")) or ".." in name.split("/"):
                raise ValueError(f"not a name of an image: {name!r}")
            draft = f"{base}/_drafts-{self.job}/{uuid.uuid4().hex}"
            fs.create_dir(draft.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(draft) as f:
                f.write(bytes(row["content"] or b""))
            out.append((name, draft))
        return Drafts(out)

    def commit(self, messages: list[Drafts | None]) -> None:
        fs, base = _at(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = [n for n, _ in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("two rows share the name of an image")
        fs.create_dir(base, recursive=True)
        known = self._known(fs, base)
        for n in known if self.overwrite else []:
            fs.delete_file(f"{base}/{n}")
        for name, draft in files:
            fs.create_dir(f"{base}/{name}".rsplit("/", 1)[0], recursive=True)
            fs.move(draft, f"{base}/{name}")
        with fs.open_output_stream(f"{base}/{MANIFEST}") as f:
            f.write(json.dumps(sorted({*names, *([] if self.overwrite else known)})).encode())
        self.abort([])

    def abort(self, messages: list[Drafts | None]) -> None:
        from pyarrow.fs import FileType

        fs, base = _at(self.path)
        drafts = f"{base}/_drafts-{self.job}"
        if fs.get_file_info(drafts).type == FileType.Directory:
            fs.delete_dir(drafts)

    @staticmethod
    def _known(fs, base: str) -> list[str]:
        from pyarrow.fs import FileType

        if fs.get_file_info(f"{base}/{MANIFEST}").type != FileType.File:
            return []
        with fs.open_input_stream(f"{base}/{MANIFEST}") as f:
            return json.loads(f.read())


class PageImages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_images"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> ImageWriter:
        return ImageWriter(self.options["path"], overwrite)


def write_images(images: DataFrame, path: str, mode: str = "append") -> None:
    """Write name and content as files below path. The commit moves files, a call each, as committers of tables do."""
    images.sparkSession.dataSource.register(PageImages)
    images.select("name", "content").write.format("page_images").mode(mode).option("path", path).save()


def snippet_name(number: Column, sample: Column, row: Column) -> Column:
    """Where a row's snippet is kept: its number, sample and row."""
    return F.concat(F.lit("snippets/"), F.format_string("%03d", number.cast("int")), F.lit("_"), sample.cast("string"), F.lit("_row_"), row.cast("string"), F.lit(".png"))


def snippets(rows: DataFrame, images: DataFrame) -> DataFrame:
    """name and content of a crop around each row (sample_id, name, top, bottom) of a page image (sample_id, pixels, width).

    Rows of a page meet its image once, so an image is decoded once however many rows are cut from it; a row without an
    image, and an image without rows, give nothing. The crop has a pad of at least 36 pixels and 1.2 times the row's
    height, and a frame around the row.
    """

    def each(key: tuple, wanted: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out = []
        for data, width in zip(pages["pixels"].head(1), pages["width"].head(1), strict=True):
            page = np.frombuffer(data, np.uint8).reshape(-1, int(width))
            for name, top, bottom in zip(wanted["name"], wanted["top"], wanted["bottom"], strict=True):
                out.append((name, png(framed(page, int(top), int(bottom)))))
        return pd.DataFrame(out, columns=["name", "content"])

    left, right = rows.select("sample_id", "name", F.coalesce("top", F.lit(0)).alias("top"), F.coalesce("bottom", F.coalesce("top", F.lit(0)) + 40).alias("bottom")), images.select("sample_id", "pixels", "width")
    return left.groupBy("sample_id").cogroup(right.groupBy("sample_id")).applyInPandas(each, "name string, content binary")


def framed(page: np.ndarray, top: int, bottom: int) -> np.ndarray:
    """The band of a row with its pad, and a frame of four pixels around the row."""
    pad = max(36, int((bottom - top) * 1.2))
    first, last = max(0, top - pad), max(1, min(page.shape[0], bottom + pad))
    crop = page[min(first, last - 1) : last].copy()
    a, b = np.clip([top - first, bottom - first], 0, crop.shape[0] - 1)
    x = crop.shape[1] - 3
    for y in (slice(a, a + 4), slice(max(a, b - 3), b + 1)):
        crop[y, 2:x] = 128
    crop[a : b + 1, 2:6] = crop[a : b + 1, max(2, x - 4) : x] = 128
    return crop
