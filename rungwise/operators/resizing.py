"""Resizing whole image tables in Arrow batches.

``functions.images.resize`` is one built-in expression and fits small images.
For large ones it is slow, cell by cell; here numpy blends whole images, a
bounded number of pixels at a time, so memory does not grow with a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from rungwise.functions.images import Shape

PIXELS_AT_ONCE = 1 << 22


def _axis(size: int, out: int, method: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, share of high) of each output cell: half-pixel centres, clamped."""
    centre = (np.arange(out) + 0.5) * size / out
    if method == "nearest":
        low = np.minimum(size - 1, np.floor(centre).astype(np.int64))
        return low, low, np.zeros(out)
    at = np.clip(centre - 0.5, 0.0, size - 1.0)
    low = np.floor(at).astype(np.int64)
    return low, np.minimum(low + 1, size - 1), at - low


def resize_rows(
    df: DataFrame, pixels: str, shape: Shape, out_h: int, out_w: int, method: str = "bilinear"
) -> DataFrame:
    """``df`` with its images resampled, the same values as ``functions.images.resize``; null stays null.

    An image with another number of values than ``shape`` says is an error.
    """
    if method not in ("bilinear", "nearest"):
        raise ValueError("method must be bilinear or nearest")
    place, names = df.columns.index(pixels), df.columns
    step = max(1, PIXELS_AT_ONCE // (max(shape.h * shape.w, out_h * out_w) * shape.c))
    (top, bottom, down), (left, right, across) = _axis(shape.h, out_h, method), _axis(shape.w, out_w, method)
    down, across = down[None, :, None, None], across[None, None, :, None]

    def resampled(images: list) -> list:
        known = [k for k, image in enumerate(images) if image is not None]
        out: list = [None] * len(images)
        if known:
            data = np.array([images[k] for k in known], dtype=np.float64).reshape(-1, *shape)
            rows = data[:, :, left] * (1.0 - across) + data[:, :, right] * across
            whole = (rows[:, top] * (1.0 - down) + rows[:, bottom] * down).astype(np.float32)
            for k, image in zip(known, whole):
                out[k] = image.ravel()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                columns = part.columns
                columns[place] = pa.array(resampled(part.column(place).to_pylist()), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = T.ArrayType(T.FloatType())
    fields = [T.StructField(f.name, kind if f.name == pixels else f.dataType) for f in df.schema.fields]
    return df.mapInArrow(run, T.StructType(fields))
