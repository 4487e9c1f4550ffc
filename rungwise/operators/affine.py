"""Turns, shifts, scalings and flips as one matrix per row and one resampling.

Each change says where a cell of the output lies in the input; changes in a row compose to one
such map, worked out by column expressions. Whole images are then sampled once, with
numpy on Arrow batches, a bounded number of pixels at a time. A chain of ``functions.images`` samples
after every change; here the values between two changes are never rounded to cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rungwise.functions.images import EDGES, HALF_SLACK, Shape

PIXELS_AT_ONCE = 1 << 20
MAP = "_map"


class Affine(NamedTuple):
    """An output cell (r, c), counted from the centre, lies at (rr*r + rc*c + dr, cr*r + cc*c + dc) of the input."""

    rr: Column
    rc: Column
    cr: Column
    cc: Column
    dr: Column
    dc: Column


def _number(value: Column | float) -> Column:
    return value.cast("double") if isinstance(value, Column) else F.lit(float(value))


def rotation(angle: Column) -> Affine:
    return Affine(F.cos(angle), -F.sin(angle), F.sin(angle), F.cos(angle), _number(0), _number(0))


def shift(shape: Shape, down: Column, across: Column) -> Affine:
    """By shares of the height and width."""
    return Affine(_number(1), _number(0), _number(0), _number(1), -down * shape.h, -across * shape.w)


def scaling(amount: Column) -> Affine:
    """Above 0 zooms out, below 0 zooms in."""
    return Affine(1.0 + amount, _number(0), _number(0), 1.0 + amount, _number(0), _number(0))


def mirror(across: Column, down: Column) -> Affine:
    def side(turned: Column) -> Column:
        return F.when(turned, -1.0).otherwise(1.0)

    return Affine(side(down), _number(0), _number(0), side(across), _number(0), _number(0))


def after(first: Affine, second: Affine) -> Affine:
    """``first``, then ``second``: the second's map leads into the first's."""
    a, b = first, second
    return Affine(
        a.rr * b.rr + a.rc * b.cr, a.rr * b.rc + a.rc * b.cc, a.cr * b.rr + a.cc * b.cr, a.cr * b.rc + a.cc * b.cc,
        a.rr * b.dr + a.rc * b.dc + a.dr, a.cr * b.dr + a.cc * b.dc + a.dc,
    )


def composed(*changes: Affine) -> Affine:
    """The changes in this order, as one."""
    return reduce(after, changes)


def _inside(index: np.ndarray, size: int, edge: str) -> np.ndarray:
    """Source cells after the edge rule; -1 marks a cell to fill."""
    if edge == "nearest":
        return np.clip(index, 0, size - 1)
    if edge == "wrap":
        return index % size
    if edge == "reflect":
        turn = index % (2 * size)
        return np.minimum(turn, 2 * size - 1 - turn)
    return np.where((index >= 0) & (index < size), index, -1)


def sampled(images: np.ndarray, maps: np.ndarray, edge: str, fill: float, method: str) -> np.ndarray:
    """Images (n, h, w, c) under their maps (n, 6)."""
    n, h, w, _ = images.shape
    up, right = np.arange(h)[:, None] - (h - 1) / 2.0, np.arange(w)[None, :] - (w - 1) / 2.0
    rr, rc, cr, cc, dr, dc = (maps[:, k, None, None] for k in range(6))
    at_r, at_c = rr * up + rc * right + dr + (h - 1) / 2.0, cr * up + cc * right + dc + (w - 1) / 2.0
    image = np.arange(n)[:, None, None]

    def cells(row: np.ndarray, col: np.ndarray) -> np.ndarray:
        r, c = _inside(row, h, edge), _inside(col, w, edge)
        values = images[image, r, c]
        if edge == "constant":
            values[(r < 0) | (c < 0)] = fill
        return values

    if method == "nearest":
        return cells(*(np.floor(at + (0.5 + HALF_SLACK)).astype(np.int64) for at in (at_r, at_c)))
    low_r, low_c = np.floor(at_r), np.floor(at_c)
    down, across = (at_r - low_r)[..., None], (at_c - low_c)[..., None]
    row, col = low_r.astype(np.int64), low_c.astype(np.int64)
    upper = cells(row, col) * (1.0 - across) + cells(row, col + 1) * across
    lower = cells(row + 1, col) * (1.0 - across) + cells(row + 1, col + 1) * across
    return upper * (1.0 - down) + lower * down


def affine_rows(
    df: DataFrame, pixels: str, shape: Shape, change: Affine, edge: str = "nearest", fill: float = 0.0, method: str = "nearest"
) -> DataFrame:
    """``df`` with its images (flat arrays) under each row's own map; a null image or map gives null.

    An image with another number of values than ``shape`` says is an error.
    """
    if edge not in EDGES or method not in ("bilinear", "nearest"):
        raise ValueError(f"edge must be one of {EDGES}, method bilinear or nearest")
    names, place = df.columns, df.columns.index(pixels)
    step = max(1, PIXELS_AT_ONCE // (shape.h * shape.w * shape.c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                images, maps = part.column(place).to_pylist(), part.column(len(names)).to_pylist()
                known = [k for k, image in enumerate(images) if image is not None and None not in maps[k]]
                out: list = [None] * len(images)
                if known:
                    data = np.array([images[k] for k in known], dtype=np.float64).reshape(-1, *shape)
                    whole = sampled(data, np.array([maps[k] for k in known]), edge, fill, method).astype(np.float32)
                    for k, image in zip(known, whole):
                        out[k] = image.ravel()
                columns = part.columns[: len(names)]
                columns[place] = pa.array(out, pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField(f.name, T.ArrayType(T.FloatType()) if f.name == pixels else f.dataType) for f in df.schema.fields]
    mapped = df.select(*names, F.array(*(value.cast("double") for value in change)).alias(MAP))
    return mapped.mapInArrow(run, T.StructType(fields))
