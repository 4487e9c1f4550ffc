"""CSV scans, previews and array rows."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

CORRUPT, FIELDS = "_corrupt", "(fields)"

# The census columns in file order; double = continuous, string = nominal.
CENSUS_SCHEMA = (
    "age double, workclass string, fnlwgt double, education string, education_num double, "
    "marital_status string, occupation string, relationship string, race string, sex string, "
    "capital_gain double, capital_loss double, hours_per_week double, native_country string, "
    "label string"
)


def csv_scan_infer(spark: SparkSession, path: str, sampling: float = 1.0) -> DataFrame:
    """A headerless CSV as ``_c0, _c1, ...`` with inferred types.

    Inference reads the file once more; ``sampling`` below 1 types a share of
    the lines only. ``csv_scan_schema`` needs no such pass.
    """
    return spark.read.csv(path, header=False, inferSchema=True, samplingRatio=sampling)


def csv_scan_schema(
    spark: SparkSession, path: str, schema: StructType | str = CENSUS_SCHEMA, mode: str = "PERMISSIVE"
) -> DataFrame:
    """A headerless CSV under a declared schema, blanks round values trimmed.

    ``mode`` is Spark's: PERMISSIVE nulls bad values, DROPMALFORMED drops
    their rows, FAILFAST raises.
    """
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", mode)
        .csv(path)
    )


class Checked(NamedTuple):
    """Lines of a CSV that fit their schema, and those that do not."""

    good: DataFrame
    bad: DataFrame


def csv_scan_checked(spark: SparkSession, path: str, schema: StructType | str = CENSUS_SCHEMA) -> Checked:
    """A headerless CSV under a declared schema, with a channel for bad lines.

    ``good`` has the schema's columns of every line that fits; ``bad`` has (path, line, failing):
    the first column whose text is no value of its type, or ``FIELDS`` if the number of fields is
    wrong. Every line that is not blank is in one of them. Each is a scan of its own with plain
    expressions; an empty field is null and fits. Fields do not span lines.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}

    def parsed(kinds: list[str]) -> Column:
        columns = [f"`{f.name}` {kind}" for f, kind in zip(fields, kinds)]
        return F.from_csv("value", ", ".join([*columns, f"`{CORRUPT}` string"]), options)

    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("_path"))
    typed = lines.withColumn("_row", parsed([f.dataType.simpleString() for f in fields]))
    good = typed.filter(F.col("_row")[CORRUPT].isNull()).select(*[F.col("_row")[f.name].alias(f.name) for f in fields])
    bad = typed.filter(F.col("_row")[CORRUPT].isNotNull()).withColumn("_text", parsed(["string"] * len(fields)))
    failing = [
        F.when(F.col("_text")[f.name].isNotNull() & F.col("_text")[f.name].try_cast(f.dataType).isNull(), f.name) for f in fields
    ]
    first = F.when(F.col("_text")[CORRUPT].isNotNull(), FIELDS).otherwise(F.coalesce(*failing))
    return Checked(good, bad.select(F.col("_path").alias("path"), F.col("value").alias("line"), first.alias("failing")))


def preview_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by key: a top-n per task, not a sort of the table."""
    return df.orderBy(key).limit(n)


def array_rows(
    features: DataFrame, key: str, array: str, label: str, labels: DataFrame | None = None
) -> DataFrame:
    """(key, array, label), one row per example.

    Labels in a table of their own are joined on the key, never by position.
    """
    if labels is None:
        return features.select(key, array, label)
    return features.select(key, array).join(labels.select(key, label), key)


def image_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Raw image files as (path, content bytes); decoding is the caller's."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("content"))


def decoded_images(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Image files as (path, height, width, channels, pixels): rows of cells from the top, channels red first.

    Spark's image source decodes in its readers. A file that is no image has a row with null sizes and pixels.
    """
    schema = "path string, height int, width int, channels int, pixels array<int>"
    names = [field.split(" ")[0] for field in schema.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():  # one image at a time
                out = [row["origin"], None, None, None, None]
                if row["height"] > 0:
                    h, w, c = row["height"], row["width"], row["nChannels"]
                    cells = np.frombuffer(row["data"], dtype=np.uint8).reshape(h, w, c)
                    order = [2, 1, 0, *range(3, c)] if c >= 3 else list(range(c))  # stored blue first
                    out = [row["origin"], h, w, c, cells[..., order].ravel()]
                yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(out, kinds)], names=names)

    files = spark.read.format("image").option("pathGlobFilter", pattern).option("dropInvalid", False).load(path)
    return files.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data").mapInArrow(run, schema)
