"""Image operators on flat pixel arrays (row-major, channel last).

Every operator is a gather: the output cell (row, col) copies the input cell
found by the inverse map. Flip, shift, zoom and resize move rows and columns
independently, so their source rows and columns are worked out once per image
and not once per pixel; only rotation works cell by cell.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from rungwise.functions.arrays import bind


class Shape(NamedTuple):
    h: int
    w: int
    c: int = 1


# Lifts positions that fall just short of a half by rounding error.
HALF_SLACK = 1e-9

# Edge rules for source cells outside the image.
EDGES = ("nearest", "constant", "reflect", "wrap")


def _steps(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _inside(index: Column, size: int, edge: str) -> Column:
    """A source index after the edge rule; -1 marks a cell to fill."""
    if edge == "nearest":
        return F.greatest(F.lit(0), F.least(F.lit(size - 1), index))
    if edge == "wrap":
        return F.pmod(index, F.lit(size))
    if edge == "reflect":
        turn = F.pmod(index, F.lit(2 * size))
        return F.least(turn, F.lit(2 * size - 1) - turn)
    if edge == "constant":
        return F.when((index >= 0) & (index < size), index).otherwise(F.lit(-1))
    raise ValueError(f"edge must be one of {EDGES}")


def _nearest(position: Column) -> Column:
    """The cell nearest to a position, halves up."""
    return F.floor(position + (0.5 + HALF_SLACK)).cast("int")


def _pick(pixels: Column, shape: Shape, rows: Column, cols: Column, fill: float) -> Column:
    """Gather by independent source rows and columns (int arrays)."""
    fill_pixel = F.array_repeat(F.lit(fill).cast("float"), shape.c)
    stride = shape.w * shape.c

    def gather(image: Column) -> Column:
        def cell(row: Column, col: Column) -> Column:
            start = row * stride + col * shape.c
            if shape.c == 1:
                taken, filled = F.get(image["pixels"], start), F.lit(fill).cast("float")
            else:
                taken, filled = F.slice(image["pixels"], start + 1, shape.c), fill_pixel
            return F.when((row < 0) | (col < 0), filled).otherwise(taken)

        grid = F.transform(
            image["rows"], lambda row: F.transform(image["cols"], lambda col: cell(row, col))
        )
        return F.flatten(grid) if shape.c == 1 else F.flatten(F.flatten(grid))

    return _of_image(pixels, gather, rows=rows, cols=cols)


def _blend(pixels: Column, shape: Shape, position, edge: str, fill: float, **values: Column) -> Column:
    """Bilinear samples: output cell (row, col) lies at ``position(image, row, col)`` of the input.

    The four cells around a position each follow the edge rule by themselves.
    """
    channels = _steps(shape.c)

    def sample(image: Column) -> Column:
        def corner(row: Column, col: Column, channel: Column) -> Column:
            r, c = _inside(row, shape.h, edge), _inside(col, shape.w, edge)
            value = F.get(image["pixels"], (r * shape.w + c) * shape.c + channel).cast("double")
            return F.when((r < 0) | (c < 0), F.lit(float(fill))).otherwise(value) if edge == "constant" else value

        def blended(at: Column) -> Column:
            row, col = F.floor(at["r"]).cast("int"), F.floor(at["c"]).cast("int")
            down, across = at["r"] - row, at["c"] - col
            return F.transform(
                channels,
                lambda k: (
                    (corner(row, col, k) * (1.0 - across) + corner(row, col + 1, k) * across) * (1.0 - down)
                    + (corner(row + 1, col, k) * (1.0 - across) + corner(row + 1, col + 1, k) * across) * down
                ).cast("float"),
            )

        def cell(row: Column, col: Column) -> Column:
            at_r, at_c = position(image, row, col)
            return bind({"r": at_r, "c": at_c}, blended)

        grid = F.transform(_steps(shape.h), lambda r: F.transform(_steps(shape.w), lambda c: cell(r, c)))
        return F.flatten(F.flatten(grid))

    return _of_image(pixels, sample, **values)


def _of_image(pixels: Column, body, **values: Column) -> Column:
    """``body`` of the float pixels and other values of one image; null for a null image."""
    floats = pixels.cast("array<float>")
    return bind({"pixels": floats, **values}, lambda image: F.when(image["pixels"].isNotNull(), body(image)))


def flatten_image(nested: Column) -> Column:
    """h x w x c nested arrays to one flat array."""
    return F.flatten(F.flatten(nested))


def nest_image(pixels: Column, shape: Shape) -> Column:
    """The inverse of ``flatten_image``."""
    stride = shape.w * shape.c

    def nest(image: Column) -> Column:
        def pixel(row: Column, col: Column) -> Column:
            return F.slice(image["pixels"], row * stride + col * shape.c + 1, shape.c)

        return F.transform(_steps(shape.h), lambda row: F.transform(_steps(shape.w), lambda col: pixel(row, col)))

    return _of_image(pixels, nest)


def scale_pixels(pixels: Column, top: float = 255.0) -> Column:
    """Integer pixels to floats in [0, 1]."""
    return F.transform(pixels, lambda v: (v.cast("float") / F.lit(top)).cast("float"))


def flip(pixels: Column, shape: Shape, across: Column | bool = True, down: Column | bool = False) -> Column:
    """Mirror left-right (``across``) and top-bottom (``down``); either may differ per row."""

    def order(size: int, turned: Column | bool) -> Column:
        if isinstance(turned, bool):
            return F.reverse(_steps(size)) if turned else _steps(size)
        return F.when(turned, F.reverse(_steps(size))).otherwise(_steps(size))

    return _pick(pixels, shape, order(shape.h, down), order(shape.w, across), 0.0)


def translate(
    pixels: Column, shape: Shape, down: Column, across: Column, edge: str = "nearest", fill: float = 0.0,
    method: str = "nearest",
) -> Column:
    """Shift by shares of the height and width; ``method`` is nearest or bilinear."""
    if method == "bilinear":
        def moved(image: Column, row: Column, col: Column) -> tuple[Column, Column]:
            return row - image["down"] * shape.h, col - image["across"] * shape.w

        return _blend(pixels, shape, moved, edge, fill, down=down, across=across)
    rows = F.transform(_steps(shape.h), lambda i: _inside(_nearest(i - down * shape.h), shape.h, edge))
    cols = F.transform(_steps(shape.w), lambda i: _inside(_nearest(i - across * shape.w), shape.w, edge))
    return _pick(pixels, shape, rows, cols, fill)


def zoom(
    pixels: Column, shape: Shape, amount: Column, edge: str = "nearest", fill: float = 0.0, method: str = "nearest"
) -> Column:
    """Scale about the centre: above 0 zooms out, below 0 zooms in; ``method`` is nearest or bilinear."""
    if method == "bilinear":
        def scaled(image: Column, row: Column, col: Column) -> tuple[Column, Column]:
            mid_r, mid_c = (shape.h - 1) / 2.0, (shape.w - 1) / 2.0
            return (row - mid_r) * (1.0 + image["amount"]) + mid_r, (col - mid_c) * (1.0 + image["amount"]) + mid_c

        return _blend(pixels, shape, scaled, edge, fill, amount=amount)

    def sources(size: int) -> Column:
        middle = (size - 1) / 2.0
        return F.transform(
            _steps(size), lambda i: _inside(_nearest((i - middle) * (1.0 + amount) + middle), size, edge)
        )

    return _pick(pixels, shape, sources(shape.h), sources(shape.w), fill)


def rotate(
    pixels: Column, shape: Shape, angle: Column, edge: str = "nearest", fill: float = 0.0, method: str = "nearest"
) -> Column:
    """Turn about the centre by ``angle`` radians; ``method`` is nearest or bilinear."""
    mid_r, mid_c = (shape.h - 1) / 2.0, (shape.w - 1) / 2.0
    fill_pixel = F.array_repeat(F.lit(fill).cast("float"), shape.c)
    if method == "bilinear":
        def turned_to(image: Column, row: Column, col: Column) -> tuple[Column, Column]:
            up, right = row - mid_r, col - mid_c
            return up * image["cos"] - right * image["sin"] + mid_r, up * image["sin"] + right * image["cos"] + mid_c

        blended = _blend(pixels, shape, turned_to, edge, fill, cos=F.cos(angle), sin=F.sin(angle))
        return F.when(angle.isNotNull(), blended)

    def gather(image: Column) -> Column:
        def cell(row: Column, col: Column) -> Column:
            up, right = row - mid_r, col - mid_c
            at_r = up * image["cos"] - right * image["sin"] + mid_r
            at_c = up * image["sin"] + right * image["cos"] + mid_c
            src_r, src_c = _inside(_nearest(at_r), shape.h, edge), _inside(_nearest(at_c), shape.w, edge)
            start = (src_r * shape.w + src_c) * shape.c
            if shape.c == 1:
                taken, filled = F.get(image["pixels"], start), F.lit(fill).cast("float")
            else:
                taken, filled = F.slice(image["pixels"], start + 1, shape.c), fill_pixel
            if edge == "constant":
                return F.when((src_r < 0) | (src_c < 0), filled).otherwise(taken)
            return taken

        grid = F.transform(_steps(shape.h), lambda r: F.transform(_steps(shape.w), lambda c: cell(r, c)))
        return F.flatten(grid) if shape.c == 1 else F.flatten(F.flatten(grid))

    turned = _of_image(pixels, gather, cos=F.cos(angle), sin=F.sin(angle))
    return F.when(angle.isNotNull(), turned)


def _nearest_sources(size: int, out: int) -> Column:
    cells = [min(size - 1, math.floor((i + 0.5) * size / out)) for i in range(out)]
    return F.expr(f"array({', '.join(map(str, cells))})")


def _bilinear_sources(size: int, out: int) -> Column:
    """(low, high, share of high, share of low) per output cell: half-pixel centres, clamped."""
    cells = []
    for i in range(out):
        at = min(max((i + 0.5) * size / out - 0.5, 0.0), size - 1.0)
        low = math.floor(at)
        share, high = at - low, min(low + 1, size - 1)
        cells.append(f"struct({low} AS low, {high} AS high, {share!r}D AS share, {1.0 - share!r}D AS rest)")
    return F.expr(f"array({', '.join(cells)})")


def resize(pixels: Column, shape: Shape, out_h: int, out_w: int, method: str = "bilinear") -> Column:
    """Resample to ``out_h`` x ``out_w``; ``bilinear`` or ``nearest``.

    Bilinear blends along the rows first and then blends whole rows, so a cell
    costs two small sums and not one over four corners.
    """
    if method == "nearest":
        return _pick(
            pixels, shape, _nearest_sources(shape.h, out_h), _nearest_sources(shape.w, out_w), 0.0
        )
    if method != "bilinear":
        raise ValueError("method must be bilinear or nearest")
    stride, channels = shape.w * shape.c, shape.c

    def along(image: Column, row: Column, at: Column) -> Column:
        low, high = row * stride + at["low"] * channels, row * stride + at["high"] * channels
        if channels == 1:
            return F.get(image["pixels"], low) * at["rest"] + F.get(image["pixels"], high) * at["share"]
        return F.zip_with(
            F.slice(image["pixels"], low + 1, channels),
            F.slice(image["pixels"], high + 1, channels),
            lambda a, b: a * at["rest"] + b * at["share"],
        )

    def blended_row(image: Column, row: Column) -> Column:
        cells = F.transform(_bilinear_sources(shape.w, out_w), lambda at: along(image, row, at))
        return cells if channels == 1 else F.flatten(cells)

    def down(grid: Column) -> Column:
        return F.flatten(
            F.transform(
                _bilinear_sources(shape.h, out_h),
                lambda at: F.zip_with(
                    F.get(grid["rows"], at["low"]),
                    F.get(grid["rows"], at["high"]),
                    lambda a, b: (a * at["rest"] + b * at["share"]).cast("float"),
                ),
            )
        )

    def blend(image: Column) -> Column:
        return bind({"rows": F.transform(_steps(shape.h), lambda row: blended_row(image, row))}, down)

    return _of_image(pixels, blend)
