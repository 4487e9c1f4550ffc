"""Run logs: rows of (m, dt, a) appended to CSV folders, one folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

LOG_SCHEMA = "m int, dt double, a double"

# Fixed value: run settings at the end of a log's name, ..._{max_m}_{nodes}_{cpus}.csv
NAME_PATTERN = r"_(\d+)_(\d+)_(\d+)\.csv"


def run_name(max_m: int, nodes: int, cpus: int, kind: str = "ladder") -> str:
    """The name of a run, with its settings where ``runlog_scan`` looks for them."""
    return f"{kind}_{max_m}_{nodes}_{cpus}.csv"


def runlog_append(log: DataFrame, path: str, run: str = "run", restart: bool = False) -> None:
    """Append rows under ``path/run=<run>/``; with ``restart`` they replace what these runs had.

    Rows are rebalanced by run before the write: adaptive execution splits a
    large run over several tasks and packs small ones together.
    """
    (
        log.hint("rebalance", F.col(run))
        .write.mode("overwrite" if restart else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run)
        .option("header", True)
        .csv(path)
    )


def runlog_commit(log: DataFrame, path: str, run: str = "run", key: str = "m") -> None:
    """Write rows under ``path/run=<run>/m=<m>/``, replacing what these keys had and nothing else.

    A rung that is run again replaces itself, and studies may write at once: each write is staged in a
    folder of its own and moves whole partitions. One partition per key, so this is for logs of
    few rows per run; ``runlog_append`` takes any number.
    """
    (
        log.hint("rebalance", F.col(run), F.col(key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run, key)
        .option("header", True)
        .csv(path)
    )


def runlog_read(spark: SparkSession, path: str, schema: str = LOG_SCHEMA) -> DataFrame:
    """What ``runlog_append`` or ``runlog_commit`` wrote: the log's columns and the run's."""
    return spark.read.option("header", True).schema(schema).csv(path)


def runlog_scan(spark: SparkSession, paths: str | list[str], schema: str = LOG_SCHEMA) -> DataFrame:
    """Many logs at once, with the run settings taken from their names.

    Reads logs with or without an accuracy column (null if absent), with
    blanks after commas, or with a header only.
    """
    logs = (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(paths)
    )
    name = F.col("_metadata.file_path")
    settings = {
        column: F.try_to_number(F.regexp_extract(name, NAME_PATTERN, group), F.lit("9999999999")).cast("int")
        for group, column in enumerate(("max_m", "nodes", "cpus"), start=1)
    }
    named = StructType.fromDDL(schema).names  # a committed log has its key in the path, which comes last
    others = [c for c in logs.columns if c not in named]
    return logs.select(*named, *others, *[value.alias(column) for column, value in settings.items()])
