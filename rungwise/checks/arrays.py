"""Array and image operators; embeddings stand in for 8x8 images."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from rungwise.checks.inputs import CELLS, CLASSES, GRID, amount_sql, hash_sql, images as image_table, table
from rungwise.checks.registry import query
from rungwise.functions import images, losses
from rungwise.functions.hashing import hash_amount
from rungwise.operators import affine, augment
from rungwise.operators.columns import long_form
from rungwise.operators.growth import union_all
from rungwise.operators.resizing import resize_rows
from rungwise.sources.tables import array_rows as pair_rows

ROW, COL = "(position // 8)", "(position % 8)"


def nearest_sql(position: str) -> str:
    return f"CAST(greatest(0, least(7, floor({position} + {0.5 + images.HALF_SLACK!r}::DOUBLE))) AS INTEGER)"


def gather_sql(source: str, images_of: str = "pictures") -> str:
    """Every cell takes the value of the cell at position ``source`` of its image."""
    return f"SELECT vec_id, label, [pixels[({source}) + 1] FOR position IN range(64)] AS pixels FROM {images_of}"


PICTURES = """pictures AS (
    SELECT vec_id, label,
           [CAST(greatest(0, least(255, floor((v::DOUBLE + 1.0::DOUBLE) * 127.5::DOUBLE))) AS INTEGER) FOR v IN embedding] AS pixels
    FROM embeddings)"""


def cells_sql(images_of: str, columns: str = "vec_id") -> str:
    return f"SELECT {columns}, CAST(i AS INTEGER) AS position, pixels[i + 1]::DOUBLE AS value FROM {images_of}, range(64) AS r(i)"


ANGLE = amount_sql("vec_id", augment.TURN * 2.0 * math.pi, 42, augment.ANGLE_DRAW)
DOWN = amount_sql("vec_id", augment.SHIFT, 42, augment.DOWN_DRAW)
ACROSS = amount_sql("vec_id", augment.SHIFT, 42, augment.ACROSS_DRAW)
SCALE = amount_sql("vec_id", augment.SCALE, 42, augment.SCALE_DRAW)
FLIPPED_ACROSS = f"{hash_sql('vec_id', 42, augment.FLIP_ACROSS_DRAW)} < 2147483648"
FLIPPED_DOWN = f"{hash_sql('vec_id', 42, augment.FLIP_DOWN_DRAW)} < 2147483648"

ROTATED = (
    nearest_sql(f"({ROW} - 3.5::DOUBLE) * cos({ANGLE}) - ({COL} - 3.5::DOUBLE) * sin({ANGLE}) + 3.5::DOUBLE")
    + " * 8 + "
    + nearest_sql(f"({ROW} - 3.5::DOUBLE) * sin({ANGLE}) + ({COL} - 3.5::DOUBLE) * cos({ANGLE}) + 3.5::DOUBLE")
)
TRANSLATED = nearest_sql(f"{ROW} - {DOWN} * 8") + " * 8 + " + nearest_sql(f"{COL} - {ACROSS} * 8")
ZOOMED = " * 8 + ".join(
    nearest_sql(f"({axis} - 3.5::DOUBLE) * (1.0::DOUBLE + {SCALE}) + 3.5::DOUBLE") for axis in (ROW, COL)
)
FLIPPED = (
    f"CASE WHEN {FLIPPED_DOWN} THEN 7 - {ROW} ELSE {ROW} END * 8"
    f" + CASE WHEN {FLIPPED_ACROSS} THEN 7 - {COL} ELSE {COL} END"
)


def image_sql(source: str) -> str:
    return f"WITH {PICTURES}, changed AS ({gather_sql(source)}) {cells_sql('changed')}"


def cells(df, array: str = "pixels"):
    return long_form(df, ["vec_id"], array).withColumn("value", F.col("value").cast("double"))


def changed(spark, sf_dir, change):
    df = image_table(spark, sf_dir)
    return cells(df.withColumn("pixels", change(F.col("pixels"))))


@query(
    "array_rows",
    f"WITH {CELLS} SELECT vec_id, label, position, round(x::DOUBLE, 6) + 0.0 AS value FROM cells",
)
def array_rows(spark, sf_dir):
    df = pair_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    wide = long_form(df, ["vec_id", "label"], "embedding")
    return wide.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query(
    "cast_float_scale",
    f"""WITH {CELLS}
    SELECT vec_id, position, round(CAST(pixel::FLOAT / 255::FLOAT AS DOUBLE), 6) AS value FROM cells""",
)
def cast_float_scale(spark, sf_dir):
    scaled = changed(spark, sf_dir, images.scale_pixels)
    return scaled.withColumn("value", F.round("value", 6))


@query(
    "one_hot",
    f"""SELECT vec_id, CAST(c AS INTEGER) AS position, CAST(label = c AS INTEGER)::DOUBLE AS value
    FROM embeddings, range({CLASSES}) AS k(c)""",
)
def one_hot(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", losses.one_hot(F.col("label"), CLASSES).alias("y"))
    return cells(df, "y")


@query("flatten_image", f"WITH {CELLS} SELECT vec_id, position, pixel::DOUBLE AS value FROM cells")
def flatten_image(spark, sf_dir):
    return changed(spark, sf_dir, lambda pixels: images.flatten_image(images.nest_image(pixels, GRID)))


def resize_sql(out: int) -> str:
    def axis(name: str) -> str:
        at = f"greatest(0.0::DOUBLE, least(7.0::DOUBLE, ({name} + 0.5::DOUBLE) * 8 / {out} - 0.5::DOUBLE))"
        return f"{at} AS {name}_at, CAST(floor({at}) AS INTEGER) AS {name}_low, CAST(least(7, floor({at}) + 1) AS INTEGER) AS {name}_high, CAST(floor(({name} + 0.5::DOUBLE) * 8 / {out}) AS INTEGER) AS {name}_near"

    return f"""SELECT {out} AS side, CAST(r * {out} + c AS INTEGER) AS position, {axis("r")}, {axis("c")}
    FROM range({out}) AS a(r), range({out}) AS b(c)"""


RESIZED = f"""WITH {CELLS},
    grid AS ({resize_sql(4)} UNION ALL {resize_sql(12)}),
    near AS (
        SELECT vec_id, CAST(side AS INTEGER) AS side, 'nearest' AS method, grid.position, pixel::DOUBLE AS value
        FROM grid JOIN cells ON cells.position = r_near * 8 + c_near),
    smooth AS (
        SELECT a.vec_id, CAST(side AS INTEGER) AS side, 'bilinear' AS method, grid.position,
               CAST((a.pixel * (1.0 - (c_at - c_low)) + b.pixel * (c_at - c_low)) * (1.0 - (r_at - r_low))
                    + (c.pixel * (1.0 - (c_at - c_low)) + d.pixel * (c_at - c_low)) * (r_at - r_low) AS FLOAT)::DOUBLE AS value
        FROM grid
        JOIN cells a ON a.position = r_low * 8 + c_low
        JOIN cells b ON b.vec_id = a.vec_id AND b.position = r_low * 8 + c_high
        JOIN cells c ON c.vec_id = a.vec_id AND c.position = r_high * 8 + c_low
        JOIN cells d ON d.vec_id = a.vec_id AND d.position = r_high * 8 + c_high)
    SELECT vec_id, side, method, position, round(value, 4) AS value FROM near
    UNION ALL SELECT vec_id, side, method, position, round(value, 4) FROM smooth"""
KINDS = [(side, method) for side in (4, 12) for method in ("nearest", "bilinear")]


@query("image_resize", RESIZED)
def image_resize(spark, sf_dir):
    df = image_table(spark, sf_dir)
    resized = F.array(
        *[
            F.struct(
                F.lit(side).alias("side"),
                F.lit(method).alias("method"),
                images.resize(F.col("pixels"), GRID, side, side, method).alias("resized"),
            )
            for side, method in KINDS
        ]
    )
    wide = df.select("vec_id", F.inline(resized))
    cells_of = long_form(wide, ["vec_id", "side", "method"], "resized")
    return cells_of.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("image_resize_rows", RESIZED)
def image_resize_rows(spark, sf_dir):
    df = image_table(spark, sf_dir).select("vec_id", "pixels")
    sizes = [
        resize_rows(df, "pixels", GRID, side, side, method).select(
            "vec_id", F.lit(side).alias("side"), F.lit(method).alias("method"), "pixels"
        )
        for side, method in KINDS
    ]
    cells_of = long_form(union_all(*sizes), ["vec_id", "side", "method"], "pixels")
    return cells_of.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("image_flip", image_sql(FLIPPED))
def image_flip(spark, sf_dir):
    across, down = augment.random_flips("vec_id")
    return changed(spark, sf_dir, lambda pixels: images.flip(pixels, GRID, across, down))


@query("image_translate", image_sql(TRANSLATED))
def image_translate(spark, sf_dir):
    down = hash_amount("vec_id", augment.SHIFT, 42, augment.DOWN_DRAW)
    across = hash_amount("vec_id", augment.SHIFT, 42, augment.ACROSS_DRAW)
    return changed(spark, sf_dir, lambda pixels: images.translate(pixels, GRID, down, across))


@query("image_zoom", image_sql(ZOOMED))
def image_zoom(spark, sf_dir):
    amount = hash_amount("vec_id", augment.SCALE, 42, augment.SCALE_DRAW)
    return changed(spark, sf_dir, lambda pixels: images.zoom(pixels, GRID, amount))


@query("image_rotate", image_sql(ROTATED))
def image_rotate(spark, sf_dir):
    return changed(spark, sf_dir, lambda pixels: images.rotate(pixels, GRID, augment.random_angle("vec_id")))


@query("image_rotate_rows", image_sql(ROTATED))
def image_rotate_rows(spark, sf_dir):
    df = image_table(spark, sf_dir)
    return cells(affine.affine_rows(df, "pixels", GRID, affine.rotation(augment.random_angle("vec_id"))))


# All four changes as one map: where an output cell lies after each inverse, from the last change to the first.
BACK = {axis: f"CASE WHEN {turned} THEN 7 - {axis} ELSE {axis} END" for axis, turned in ((ROW, FLIPPED_DOWN), (COL, FLIPPED_ACROSS))}
SCALED = {axis: f"(({BACK[axis]}) - 3.5::DOUBLE) * (1.0::DOUBLE + {SCALE})" for axis in (ROW, COL)}
UP, RIGHT = f"({SCALED[ROW]} - {DOWN} * 8)", f"({SCALED[COL]} - {ACROSS} * 8)"
COMPOSED = (
    nearest_sql(f"{UP} * cos({ANGLE}) - {RIGHT} * sin({ANGLE}) + 3.5::DOUBLE")
    + " * 8 + "
    + nearest_sql(f"{UP} * sin({ANGLE}) + {RIGHT} * cos({ANGLE}) + 3.5::DOUBLE")
)


@query("augment_composed", image_sql(COMPOSED))
def augment_composed(spark, sf_dir):
    return cells(augment.augment_composed(image_table(spark, sf_dir), "vec_id", "pixels", GRID))


@query(
    "augment_append",
    f"""WITH {PICTURES},
    turned AS ({gather_sql(ROTATED)}),
    moved_on AS ({gather_sql(TRANSLATED, "turned")}),
    scaled AS ({gather_sql(ZOOMED, "moved_on")}),
    mirrored AS ({gather_sql(FLIPPED, "scaled")})
    {cells_sql("pictures", "vec_id, label, false AS augmented")}
    UNION ALL {cells_sql("mirrored", "vec_id, label, true AS augmented")}""",
)
def augment_append(spark, sf_dir):
    grown = augment.augment_append(image_table(spark, sf_dir), "vec_id", "pixels", GRID)
    wide = long_form(grown, ["vec_id", "label", "augmented"], "pixels")
    return wide.withColumn("value", F.col("value").cast("double"))


# A 3-channel form of the same images: a pixel, its mirror value and a constant; turned with blending, edges reflected.
SMOOTH = augment.Amounts(edge="reflect", method="bilinear")
COLOUR = images.Shape(8, 8, 3)
AT_R = f"(({ROW} - 3.5::DOUBLE) * cos({ANGLE}) - ({COL} - 3.5::DOUBLE) * sin({ANGLE}) + 3.5::DOUBLE)"
AT_C = f"(({ROW} - 3.5::DOUBLE) * sin({ANGLE}) + ({COL} - 3.5::DOUBLE) * cos({ANGLE}) + 3.5::DOUBLE)"


def reflected_sql(index: str) -> str:
    turn = f"((({index}) % 16 + 16) % 16)"
    return f"CAST(least({turn}, 15 - {turn}) AS BIGINT)"


def corner_sql(row: str, col: str) -> str:
    return f"colours[({reflected_sql(row)} * 8 + {reflected_sql(col)}) * 3 + channel + 1]"


@query(
    "image_rotate_bilinear",
    f"""WITH {PICTURES},
    coloured AS (
        SELECT vec_id, flatten([[p::DOUBLE, 255.0 - p, 7.0] FOR p IN pixels]) AS colours FROM pictures),
    placed AS (
        SELECT vec_id, colours, position, channel, {AT_R} AS at_r, {AT_C} AS at_c
        FROM coloured, range(64) AS a(position), range(3) AS b(channel)),
    corners AS (SELECT *, floor(at_r) AS r, floor(at_c) AS c, at_r - floor(at_r) AS down, at_c - floor(at_c) AS across FROM placed)
    SELECT vec_id, CAST(position * 3 + channel AS INTEGER) AS position,
           round(CAST(({corner_sql("r", "c")} * (1 - across) + {corner_sql("r", "c + 1")} * across) * (1 - down)
                 + ({corner_sql("r + 1", "c")} * (1 - across) + {corner_sql("r + 1", "c + 1")} * across) * down AS FLOAT)::DOUBLE, 3) AS value
    FROM corners""",
)
def image_rotate_bilinear(spark, sf_dir):
    df = image_table(spark, sf_dir)
    colour = F.flatten(F.transform("pixels", lambda p: F.array(p.cast("float"), (255 - p).cast("float"), F.lit(7.0).cast("float"))))
    turned = images.rotate(colour, COLOUR, augment.random_angle("vec_id"), SMOOTH.edge, method=SMOOTH.method)
    return cells(df.select("vec_id", turned.alias("pixels"))).withColumn("value", F.round("value", 3))
