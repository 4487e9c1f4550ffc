"""Random image changes whose amounts come from the row key and a seed."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from rungwise.functions import images
from rungwise.functions.hashing import hash_amount, hash_share
from rungwise.operators import affine

# Fixed values, the defaults: the largest changes, as shares of a full turn, of the side and of the scale.
TURN, SHIFT, SCALE = 0.1, 0.1, 0.1

# One draw per amount, so that amounts of one row do not move together.
ANGLE_DRAW, DOWN_DRAW, ACROSS_DRAW, SCALE_DRAW, FLIP_ACROSS_DRAW, FLIP_DOWN_DRAW = range(6)


def random_angle(key: str, turn: float = TURN, seed: int = 42) -> Column:
    return hash_amount(key, turn * 2.0 * math.pi, seed, ANGLE_DRAW)


def random_flips(key: str, seed: int = 42) -> tuple[Column, Column]:
    """(left-right, top-bottom), each for half of the rows."""
    across = hash_share(key, seed, FLIP_ACROSS_DRAW) < 0.5
    return across, hash_share(key, seed, FLIP_DOWN_DRAW) < 0.5


class Amounts(NamedTuple):
    """The largest changes and the ways of making them.

    ``turn`` is a share of a full turn, ``shift`` of the side, ``scale`` of the
    size; flips can be switched off one by one.
    """

    turn: float = TURN
    shift: float = SHIFT
    scale: float = SCALE
    flip_across: bool = True
    flip_down: bool = True
    edge: str = "nearest"
    method: str = "nearest"


def augment(
    df: DataFrame, key: str, pixels: str, shape: images.Shape, seed: int = 42, amounts: Amounts = Amounts()
) -> DataFrame:
    """Turn, shift, scale and flip every image; narrow, the label travels along."""
    how = {"edge": amounts.edge, "method": amounts.method}
    turned = df.withColumn(pixels, images.rotate(F.col(pixels), shape, random_angle(key, amounts.turn, seed), **how))
    down, across = (hash_amount(key, amounts.shift, seed, draw) for draw in (DOWN_DRAW, ACROSS_DRAW))
    moved = turned.withColumn(pixels, images.translate(F.col(pixels), shape, down, across, **how))
    amount = hash_amount(key, amounts.scale, seed, SCALE_DRAW)
    scaled = moved.withColumn(pixels, images.zoom(F.col(pixels), shape, amount, **how))
    flips = random_flips(key, seed)
    flip_across, flip_down = (
        flip if wanted else F.lit(False) for flip, wanted in zip(flips, (amounts.flip_across, amounts.flip_down))
    )
    return scaled.withColumn(pixels, images.flip(F.col(pixels), shape, flip_across, flip_down))


def augment_composed(
    df: DataFrame, key: str, pixels: str, shape: images.Shape, seed: int = 42, amounts: Amounts = Amounts()
) -> DataFrame:
    """The same changes with the same amounts, composed to one map per row and sampled once: for images of any size."""
    down, across = (hash_amount(key, amounts.shift, seed, draw) for draw in (DOWN_DRAW, ACROSS_DRAW))
    flips = zip(random_flips(key, seed), (amounts.flip_across, amounts.flip_down))
    change = affine.composed(
        affine.rotation(random_angle(key, amounts.turn, seed)),
        affine.shift(shape, down, across),
        affine.scaling(hash_amount(key, amounts.scale, seed, SCALE_DRAW)),
        affine.mirror(*(flip if wanted else F.lit(False) for flip, wanted in flips)),
    )
    return affine.affine_rows(df, pixels, shape, change, edge=amounts.edge, method=amounts.method)


def augment_append(
    df: DataFrame, key: str, pixels: str, shape: images.Shape, seed: int = 42, amounts: Amounts = Amounts()
) -> DataFrame:
    """Originals and their augmented copies, marked by ``augmented``, from one scan."""
    both = augment(df.withColumn("_original", F.col(pixels)), key, pixels, shape, seed, amounts)
    pair = F.posexplode_outer(F.array(F.col("_original").cast("array<float>"), F.col(pixels)))
    others = [c for c in df.columns if c != pixels]
    grown = both.select(*others, pair.alias("_copy", pixels))
    return grown.select(*df.columns, (F.col("_copy") == 1).alias("augmented"))
