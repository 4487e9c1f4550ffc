"""Image operators against numpy, and their identities."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rungwise.functions import images
from rungwise.functions.images import Shape
from rungwise.operators import affine, augment, resizing

SHAPES = [Shape(4, 4, 1), Shape(3, 5, 3)]


def picture(shape):
    return np.arange(shape.h * shape.w * shape.c, dtype=np.float32).reshape(shape) * 3 % 101


def apply(spark, shape, change, data=None):
    data = picture(shape) if data is None else data
    df = spark.createDataFrame([(1, data.ravel().tolist())], "k long, pixels array<float>")
    out = df.select(change(F.col("pixels")).alias("o")).first()["o"]
    return None if out is None else np.array(out, dtype=np.float32)


def brute(data, source, edge="nearest", fill=0.0):
    """out[r, c] = data[source(r, c)] with the edge rule, cell by cell."""
    h, w, _ = data.shape

    def index(i, n):
        if edge == "nearest":
            return min(max(i, 0), n - 1)
        if edge == "wrap":
            return i % n
        if edge == "reflect":
            i %= 2 * n
            return min(i, 2 * n - 1 - i)
        return i if 0 <= i < n else None

    out = np.full_like(data, fill)
    for r in range(h):
        for c in range(w):
            sr, sc = (index(math.floor(p + 0.5 + 1e-9), n) for p, n in zip(source(r, c), (h, w)))
            if sr is not None and sc is not None:
                out[r, c] = data[sr, sc]
    return out.ravel()


@pytest.mark.parametrize("shape", SHAPES)
def test_flip(spark, shape):
    data = picture(shape)
    assert (apply(spark, shape, lambda p: images.flip(p, shape)) == data[:, ::-1].ravel()).all()
    down = apply(spark, shape, lambda p: images.flip(p, shape, across=F.lit(False), down=F.lit(True)))
    assert (down == data[::-1].ravel()).all()
    twice = apply(spark, shape, lambda p: images.flip(images.flip(p, shape, True, True), shape, True, True))
    assert (twice == data.ravel()).all()


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("edge", images.EDGES)
def test_translate_zoom_rotate(spark, shape, edge):
    data, mid_r, mid_c = picture(shape), (shape.h - 1) / 2, (shape.w - 1) / 2
    moved = apply(spark, shape, lambda p: images.translate(p, shape, F.lit(0.4), F.lit(-0.7), edge, 9.0))
    assert (moved == brute(data, lambda r, c: (r - 0.4 * shape.h, c + 0.7 * shape.w), edge, 9.0)).all()
    scaled = apply(spark, shape, lambda p: images.zoom(p, shape, F.lit(0.9), edge, 9.0))
    inverse = lambda r, c: ((r - mid_r) * 1.9 + mid_r, (c - mid_c) * 1.9 + mid_c)
    assert (scaled == brute(data, inverse, edge, 9.0)).all()
    cos, sin = math.cos(0.5), math.sin(0.5)
    turned = apply(spark, shape, lambda p: images.rotate(p, shape, F.lit(0.5), edge, 9.0))
    back = lambda r, c: (
        (r - mid_r) * cos - (c - mid_c) * sin + mid_r, (r - mid_r) * sin + (c - mid_c) * cos + mid_c
    )
    assert (turned == brute(data, back, edge, 9.0)).all()


@pytest.mark.parametrize("shape", SHAPES)
def test_zero_amounts_change_nothing(spark, shape):
    data = picture(shape).ravel()
    zero = F.lit(0.0)
    assert (apply(spark, shape, lambda p: images.translate(p, shape, zero, zero)) == data).all()
    assert (apply(spark, shape, lambda p: images.zoom(p, shape, zero)) == data).all()
    assert (apply(spark, shape, lambda p: images.rotate(p, shape, zero)) == data).all()


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_resize(spark, shape, method):
    data = picture(shape).astype(np.float64)
    same = apply(spark, shape, lambda p: images.resize(p, shape, shape.h, shape.w, method))
    assert np.allclose(same, data.ravel())
    out_h, out_w = 6, 2
    want = np.zeros((out_h, out_w, shape.c))
    for r in range(out_h):
        for c in range(out_w):
            at_r, at_c = (r + 0.5) * shape.h / out_h, (c + 0.5) * shape.w / out_w
            if method == "nearest":
                want[r, c] = data[math.floor(at_r), math.floor(at_c)]
                continue
            at_r, at_c = min(max(at_r - 0.5, 0), shape.h - 1), min(max(at_c - 0.5, 0), shape.w - 1)
            lo_r, lo_c = math.floor(at_r), math.floor(at_c)
            hi_r, hi_c = min(lo_r + 1, shape.h - 1), min(lo_c + 1, shape.w - 1)
            top = data[lo_r, lo_c] * (1 - at_c + lo_c) + data[lo_r, hi_c] * (at_c - lo_c)
            low = data[hi_r, lo_c] * (1 - at_c + lo_c) + data[hi_r, hi_c] * (at_c - lo_c)
            want[r, c] = top * (1 - at_r + lo_r) + low * (at_r - lo_r)
    got = apply(spark, shape, lambda p: images.resize(p, shape, out_h, out_w, method))
    assert np.allclose(got, want.ravel(), atol=1e-4)


@pytest.mark.parametrize("shape", SHAPES)
def test_nest_then_flatten(spark, shape):
    data = picture(shape)
    df = spark.createDataFrame([(data.ravel().tolist(),)], "pixels array<float>")
    nested = df.select(images.nest_image(F.col("pixels"), shape).alias("n"))
    assert np.array_equal(np.array(nested.first()["n"]), data)
    assert nested.select(images.flatten_image(F.col("n")).alias("f")).first()["f"] == data.ravel().tolist()


def test_null_image_stays_null(spark):
    shape = Shape(4, 4, 1)
    df = spark.createDataFrame([(1, None)], "k long, pixels array<float>")
    p = F.col("pixels")
    changes = [
        images.flip(p, shape), images.resize(p, shape, 2, 2), images.rotate(p, shape, F.lit(0.1)),
        images.zoom(p, shape, F.lit(0.1)), images.scale_pixels(p),
    ]
    assert list(df.select(*[c.alias(f"c{i}") for i, c in enumerate(changes)]).first()) == [None] * 5


def test_augment_append(spark):
    shape = Shape(4, 4, 1)
    data = [(k, picture(shape).ravel().tolist(), k % 3) for k in range(40)]
    df = spark.createDataFrame(data, "vec_id long, pixels array<float>, label int")
    grown = augment.augment_append(df, "vec_id", "pixels", shape)
    rows = grown.collect()
    assert len(rows) == 80 and grown.columns == ["vec_id", "pixels", "label", "augmented"]
    assert all(r["label"] == r["vec_id"] % 3 for r in rows)
    assert all(r["pixels"] == data[0][1] for r in rows if not r["augmented"])
    assert any(r["pixels"] != data[0][1] for r in rows if r["augmented"])
    again = augment.augment_append(df.repartition(5), "vec_id", "pixels", shape).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("edge", images.EDGES)
def test_bilinear_samples(spark, shape, edge):
    data, mid_r, mid_c = picture(shape), (shape.h - 1) / 2, (shape.w - 1) / 2
    cos, sin = math.cos(0.5), math.sin(0.5)
    changes = {
        "turn": (lambda p: images.rotate(p, shape, F.lit(0.5), edge, 9.0, "bilinear"),
                 lambda r, c: ((r - mid_r) * cos - (c - mid_c) * sin + mid_r, (r - mid_r) * sin + (c - mid_c) * cos + mid_c)),
        "shift": (lambda p: images.translate(p, shape, F.lit(0.4), F.lit(-0.7), edge, 9.0, "bilinear"),
                  lambda r, c: (r - 0.4 * shape.h, c + 0.7 * shape.w)),
        "zoom": (lambda p: images.zoom(p, shape, F.lit(0.9), edge, 9.0, "bilinear"),
                 lambda r, c: ((r - mid_r) * 1.9 + mid_r, (c - mid_c) * 1.9 + mid_c)),
    }
    for change, source in changes.values():
        got, want = apply(spark, shape, change).reshape(shape), np.zeros(shape)
        corners = {
            (a, b): brute(data, lambda r, c: tuple(math.floor(p + 1e-12) + s for p, s in zip(source(r, c), (a, b))), edge, 9.0).reshape(shape)
            for a in (0, 1) for b in (0, 1)
        }
        for r in range(shape.h):
            for c in range(shape.w):
                down, across = (p - math.floor(p + 1e-12) for p in source(r, c))
                upper = corners[0, 0][r, c] * (1 - across) + corners[0, 1][r, c] * across
                want[r, c] = upper * (1 - down) + (corners[1, 0][r, c] * (1 - across) + corners[1, 1][r, c] * across) * down
        assert np.allclose(got, want, atol=1e-3)


def test_flips_can_be_switched_off(spark):
    shape = Shape(2, 2, 1)
    df = spark.createDataFrame([(k, [1.0, 2.0, 3.0, 4.0]) for k in range(40)], "k long, pixels array<float>")
    still = augment.Amounts(turn=0.0, shift=0.0, scale=0.0, flip_down=False)
    found = {tuple(r["pixels"]) for r in augment.augment(df, "k", "pixels", shape, amounts=still).collect()}
    assert found == {(1.0, 2.0, 3.0, 4.0), (2.0, 1.0, 4.0, 3.0)}


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
@pytest.mark.parametrize("shape,out", [(Shape(4, 4, 1), (9, 3)), (Shape(3, 5, 3), (7, 7)), (Shape(6, 6, 3), (2, 11))])
def test_resized_rows_equal_the_expression(spark, monkeypatch, method, shape, out):
    monkeypatch.setattr(resizing, "PIXELS_AT_ONCE", 200)
    rows = [(k, None if k == 3 else (picture(shape).ravel() * (k + 1) % 97).tolist(), "x") for k in range(9)]
    df = spark.createDataFrame(rows, "k long, pixels array<float>, label string")
    want = df.select("k", images.resize(F.col("pixels"), shape, *out, method).alias("o"))
    got = {r["k"]: r["pixels"] for r in resizing.resize_rows(df, "pixels", shape, *out, method).collect()}
    assert len(got) == 9 and got[3] is None
    assert all(r["o"] is None or np.allclose(r["o"], got[r["k"]], atol=1e-5) for r in want.collect())


ODD_SHAPE = Shape(5, 7, 3)
SINGLE = {
    "rotate": (lambda p, how: images.rotate(p, ODD_SHAPE, F.lit(0.7), **how), lambda: affine.rotation(F.lit(0.7))),
    "translate": (
        lambda p, how: images.translate(p, ODD_SHAPE, F.lit(0.31), F.lit(-0.42), **how),
        lambda: affine.shift(ODD_SHAPE, F.lit(0.31), F.lit(-0.42)),
    ),
    "zoom": (lambda p, how: images.zoom(p, ODD_SHAPE, F.lit(-0.37), **how), lambda: affine.scaling(F.lit(-0.37))),
    "flip": (
        lambda p, how: images.flip(p, ODD_SHAPE, F.lit(True), F.lit(True)),
        lambda: affine.mirror(F.lit(True), F.lit(True)),
    ),
}


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
@pytest.mark.parametrize("edge", images.EDGES)
def test_one_map_equals_the_single_expressions(spark, edge, method):
    rng = np.random.default_rng(4)
    rows = [(k, rng.integers(0, 255, 105).astype(float).tolist()) for k in range(5)] + [(9, None)]
    df = spark.createDataFrame(rows, "k long, pixels array<float>")
    how = {"edge": edge, "method": method, "fill": 9.0}
    for single, change in SINGLE.values():
        want = {r["k"]: r["o"] for r in df.select("k", single(F.col("pixels"), how).alias("o")).collect()}
        got = {r["k"]: r["pixels"] for r in affine.affine_rows(df, "pixels", ODD_SHAPE, change(), **how).collect()}
        assert got.keys() == want.keys() and got[9] is None and want[9] is None
        assert all(np.allclose(got[k], want[k], atol=1e-4) for k in range(5))


def test_maps_compose(spark, monkeypatch):
    monkeypatch.setattr(affine, "PIXELS_AT_ONCE", 200)  # pieces of a few images
    shape = Shape(9, 9, 1)
    df = spark.createDataFrame([(k, picture(shape).ravel().tolist()) for k in range(20)], "k long, pixels array<float>")
    whole = affine.composed(affine.rotation(F.lit(0.4)), affine.shift(shape, F.lit(0.2), F.lit(-0.1)), affine.scaling(F.lit(0.3)))
    undone = affine.composed(
        whole, affine.scaling(F.lit(1 / 1.3 - 1)), affine.shift(shape, F.lit(-0.2), F.lit(0.1)), affine.rotation(F.lit(-0.4)),
    )
    for row in affine.affine_rows(df, "pixels", shape, undone, method="bilinear").collect():
        assert np.allclose(row["pixels"], picture(shape).ravel(), atol=1e-3)
    quarter = affine.composed(affine.rotation(F.lit(math.pi / 4)), affine.rotation(F.lit(math.pi / 4)))
    for row in affine.affine_rows(df, "pixels", shape, quarter).collect():
        assert np.array_equal(np.array(row["pixels"]).reshape(9, 9), np.rot90(picture(shape)[..., 0], -1)) or np.array_equal(
            np.array(row["pixels"]).reshape(9, 9), np.rot90(picture(shape)[..., 0])
        )
    nothing = affine.rotation(F.when(F.col("k") < 3, F.lit(0.0)))
    kept = affine.affine_rows(df, "pixels", shape, nothing).collect()
    assert sum(r["pixels"] is None for r in kept) == 17
    with pytest.raises(ValueError):
        affine.affine_rows(df, "pixels", shape, whole, edge="none")


def test_composed_changes_are_near_the_chain(spark):
    shape = Shape(16, 16, 1)
    smooth = np.add.outer(np.arange(16.0), np.arange(16.0)).ravel().tolist()
    df = spark.createDataFrame([(k, smooth) for k in range(30)], "k long, pixels array<float>")
    amounts = augment.Amounts(turn=0.02, shift=0.03, scale=0.05, method="bilinear")
    chain = {r["k"]: np.array(r["pixels"]).reshape(16, 16) for r in augment.augment(df, "k", "pixels", shape, amounts=amounts).collect()}
    once = {r["k"]: np.array(r["pixels"]).reshape(16, 16) for r in augment.augment_composed(df, "k", "pixels", shape, amounts=amounts).collect()}
    assert all(np.allclose(chain[k][4:12, 4:12], once[k][4:12, 4:12], atol=1e-3) for k in chain)
