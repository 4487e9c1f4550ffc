"""Scans, run logs, columns, indexing, metrics and run analytics on small fixtures."""

from __future__ import annotations

import math
import struct
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from rungwise.functions import losses
from rungwise.operators import census, columns, indexing, metrics, runs
from rungwise.plans import trees
from rungwise.session import cached, scratch_path
from rungwise.sources import runlogs, tables


def test_infer_keeps_blanks_and_types(spark, census_csv):
    df = tables.csv_scan_infer(spark, census_csv)
    types = dict(df.dtypes)
    assert len(df.columns) == 15 and df.count() == 504
    assert types["_c0"] == "int" and types["_c4"] == "double" and types["_c1"] == "string"
    assert df.filter(F.col("_c1") == " ?").count() > 0
    assert {r[0] for r in df.select("_c14").distinct().collect()} == {" >50K", " <=50K"}


def test_declared_schema_trims(spark, census_csv):
    df = tables.csv_scan_schema(spark, census_csv)
    assert df.columns[0] == "age" and df.columns[-1] == "label"
    assert df.filter(F.col("workclass") == "?").count() > 0
    assert df.filter(F.col("fnlwgt").isNull()).count() == 1
    assert df.select("native_country").distinct().count() == 42


def test_bad_rows_by_mode(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("1, 2.5\nx, 3.5\n")
    read = lambda mode: tables.csv_scan_schema(spark, str(path), "a int, b double", mode)
    assert sorted(map(tuple, read("PERMISSIVE").collect()), key=str) == [(1, 2.5), (None, 3.5)]
    assert [tuple(r) for r in read("DROPMALFORMED").collect()] == [(1, 2.5)]
    with pytest.raises(Exception):
        read("FAILFAST").collect()


def test_array_rows_join_on_key(spark):
    x = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "k int, x array<double>")
    y = spark.createDataFrame([(2, 20), (1, 10)], "k int, y int")
    rows = tables.array_rows(x, "k", "x", "y", labels=y).collect()
    assert sorted((r["k"], r["x"], r["y"]) for r in rows) == [(1, [1.0], 10), (2, [2.0], 20)]


def test_image_files(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"123")
    (tmp_path / "b.txt").write_bytes(b"no")
    rows = tables.image_files(spark, str(tmp_path), "*.png").collect()
    assert len(rows) == 1 and bytes(rows[0]["content"]) == b"123"


def test_runlog_formats(spark, tmp_path):
    (tmp_path / "ladder_600_4_8.csv").write_text("m,dt,a\n1,3.5,0.84\n31,17.25,0.85\n")
    (tmp_path / "local_2_1_5.csv").write_text("m, dt\n2, 183.5\n4, 74.75")
    (tmp_path / "empty_350_1_1.csv").write_text("m,dt,a\n")
    rows = runlogs.runlog_scan(spark, f"{tmp_path}/*.csv").collect()
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == [
        (1, 3.5, 0.84, 600, 4, 8), (2, 183.5, None, 2, 1, 5), (4, 74.75, None, 2, 1, 5), (31, 17.25, 0.85, 600, 4, 8)
    ]


def test_runlog_without_settings_in_name(spark, tmp_path):
    (tmp_path / "ladder.csv").write_text("m,dt\n1,3.5\n")
    assert [tuple(r) for r in runlogs.runlog_scan(spark, str(tmp_path)).collect()] == [(1, 3.5, None, None, None, None)]


def test_runlog_appends(spark):
    path = scratch_path(spark, "log")
    for m in (1, 31):
        log = spark.createDataFrame([("r", m, 1.5 * m, 0.5)], "run string, m int, dt double, a double")
        runlogs.runlog_append(log, path)
    assert sorted(r["m"] for r in runlogs.runlog_read(spark, path).collect()) == [1, 31]


def test_fill_leaves_strings(spark):
    df = spark.createDataFrame([(None, None, 1.5)], "n int, s string, d double")
    assert tuple(columns.fill_missing_numeric(df).first()) == (0, None, 1.5)


def test_layout_puts_text_first(spark, census_csv):
    layout = columns.feature_layout(tables.csv_scan_infer(spark, census_csv))
    assert layout.label == "_c14"
    assert layout.features[:2] == ["_c1_index", "_c3_index"]
    assert layout.features[8:] == ["_c0", "_c2", "_c4", "_c10", "_c11", "_c12"]


def test_cast_is_toward_zero(spark):
    df = spark.createDataFrame([(2.7, -2.7, "x")], "a double, b double, s string")
    assert tuple(columns.cast_integer(df).first()) == (2, -2, "x")


def test_index_order_ties_and_restore(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacdd"], "s string")
    indexed = indexing.string_index(df, ["s"])
    assert dict(indexed.distinct().collect()) == {"a": 0.0, "b": 1.0, "d": 2.0, "c": 3.0}
    labelled, labels = indexing.label_index(df, "s")
    restored = indexing.label_restore(labelled, "indexedLabel", labels, "back")
    assert restored.filter(F.col("s") != F.col("back")).count() == 0


def test_wide_index_equals_indexer(spark):
    df = spark.range(3000).select((F.col("id") * F.col("id") % 701).cast("string").alias("s"), "id")
    by_model, by_join = indexing.string_index(df, ["s"]), indexing.string_index(df, ["s"], wide=("s",))
    assert sorted(map(tuple, by_model.collect())) == sorted(map(tuple, by_join.collect()))
    assert by_model.schema["s_index"].metadata == by_join.schema["s_index"].metadata != {}


def test_ranks_are_a_table_for_later_rows(spark, tmp_path):
    df = spark.createDataFrame([(v,) for v in "bbaac"], "s string")
    indexing.fit_ranks(df, ["s"]).write.parquet(str(tmp_path / "ranks"))
    ranks = spark.read.parquet(str(tmp_path / "ranks"))
    later = spark.createDataFrame([("c",), ("z",), (None,)], "s string")
    assert [r["s_index"] for r in indexing.apply_ranks(later, ranks, ["s"]).orderBy(F.desc("s")).collect()] == [3.0, 2.0, 3.0]


def test_tree_on_a_wide_column(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 1000).cast("string").alias("s"), F.when(F.col("id") % 1000 < 500, "a").otherwise("b").alias("label")
    )
    ready = indexing.label_index(indexing.string_index(rows, ["s"], wide=("s",)), "label")[0]
    whole = indexing.assemble_vector(ready, ["s_index"])
    assert trees.tree_fit(whole, bins=1000, depth=2).transform(whole).filter("prediction = indexedLabel").count() == 4000


def test_index_equals_the_stock_indexer(spark):
    df = spark.range(900).select(
        (F.col("id") * 31 % 17).cast("string").alias("s"), F.format_string("%d-é", F.col("id") % 40).alias("t")
    )
    stock = StringIndexer(inputCols=["s", "t"], outputCols=["s_index", "t_index"]).fit(df)
    ours = [tuple(stage.labels) for stage in indexing.fit_indexers(df, ["s", "t"]).stages]
    assert ours == [tuple(labels) for labels in stock.labelsArray]


@pytest.mark.parametrize("wide", [(), ("s",)])
def test_null_categories(spark, wide):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "s string")
    with pytest.raises(Exception):
        indexing.string_index(df, ["s"], wide=wide).collect()
    kept = indexing.string_index(df, ["s"], "keep", wide).collect()
    assert sorted((r["s"] or "", r["s_index"]) for r in kept) == [("", 2.0), ("a", 1.0), ("b", 0.0), ("b", 0.0)]
    assert indexing.string_index(df, ["s"], "skip", wide).count() == 3


def test_assemble_rejects_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        indexing.assemble_vector(df, ["a", "b"]).collect()


def test_one_hot_forms_agree(spark):
    df = spark.createDataFrame([(k,) for k in range(4)], "y int")
    arrays = df.select("y", losses.one_hot(F.col("y"), 4).alias("a"))
    vectors = indexing.vector_cells(indexing.one_hot_vector(df, "y", "v", 4), ["y"], "v")
    got = {(int(r["y"]), r["position"]): r["value"] for r in vectors.collect()}
    assert all(got[r["y"], i] == v for r in arrays.collect() for i, v in enumerate(r["a"]))
    assert df.limit(1).select(losses.one_hot(F.lit(None).cast("int"), 3)).first()[0] is None


def test_unknowns(spark):
    df = spark.createDataFrame([("?", 1.0), (" ?", None), ("x", 2.0)], "s string, n double")
    cleared = census.unknown_to_null(df, ["s"])
    assert [r["s"] for r in cleared.collect()] == [None, None, "x"]
    assert [r["s"] for r in census.null_to_unknown(cleared, ["s"]).collect()] == ["?", "?", "x"]
    assert tuple(census.unknown_counts(cleared, ["s", "n"]).first()) == (3, 1)
    assert census.drop_unknown(cleared, ["s", "n"]).count() == 1


def test_threshold_keeps_null(spark):
    df = spark.createDataFrame([(50000.0,), (50000.5,), (None,)], "v double")
    assert [r["label"] for r in census.label_threshold(df, "v", 50000.0).collect()] == ["<=50K", ">50K", None]


def test_duplicates_in_the_census_file(spark, census_csv):
    df = tables.csv_scan_schema(spark, census_csv)
    found = census.duplicate_conflicts(df, df.columns[:-1], "label").collect()
    assert sorted((r["copies"], r["labels"], r["conflicting"]) for r in found) == [
        (2, 1, False), (2, 1, False), (2, 2, True)
    ]


def test_class_priors_sum_to_one(spark, census_csv):
    df = census.unknown_to_null(tables.csv_scan_schema(spark, census_csv), ["workclass", "occupation"])
    rows = census.class_priors(df, "label", ["workclass", "occupation"]).collect()
    assert math.isclose(sum(r["share_all"] for r in rows), 1) and math.isclose(sum(r["share_known"] for r in rows), 1)


def test_range_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = census.range_filter(df, {"l_quantity": 16, "l_tax": 0})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,16.0)" in plan and "GreaterThan(l_tax,0.0)" in plan


def test_metrics_on_empty_table_are_null(spark):
    df = spark.createDataFrame([], "label int, prediction double, p array<double>")
    assert tuple(metrics.accuracy(df, "label").first()) == (0, None)
    assert metrics.xent_smoothed(df, "p", "label", 3).first()["loss"] is None
    assert metrics.xent_logits(df, "p", "label").first()["loss"] is None
    assert metrics.mse_arrays(df, "p", "p").first()["mse"] is None
    assert metrics.class_count(df, "label").first()["classes"] == 0


def test_accuracy_counts_null_as_wrong(spark):
    df = spark.createDataFrame([(1, 1.0), (0, None), (1, 0.0), (0, 0.0)], "label int, prediction double")
    assert metrics.accuracy(df, "label").first()["accuracy"] == 0.5
    assert columns.filter_correct(df, "label").count() == 2


def test_losses_agree_and_stand_large_scores(spark):
    df = spark.createDataFrame([([1000.0, 0.0, 999.0], 2), ([1.0, 2.0, 3.0], 0)], "s array<double>, y int")
    both = df.select(
        losses.xent_logits(F.col("s"), F.col("y")).alias("a"),
        losses.xent_smoothed(losses.softmax(F.col("s")), F.col("y"), 3).alias("b"),
    ).collect()
    assert all(math.isclose(r["a"], r["b"], rel_tol=1e-9) for r in both)
    assert math.isclose(both[0]["a"], math.log(1 + math.exp(-1)) + 1, rel_tol=1e-9)


def test_batch_gradients_average_to_the_whole(spark):
    rows = [(k, [float(k % 5), float(k % 3)], [0.2, 0.5, 0.3], k % 3) for k in range(30)]
    df = spark.createDataFrame(rows, "k int, x array<double>, p array<double>, y int")

    def gradient(part):
        cells = metrics.mean_gradient(part, "x", "p", "y", 3).collect()
        return {(r["class"], r["position"]): r["gradient"] for r in cells}

    whole, left, right = gradient(df), gradient(df.filter("k < 10")), gradient(df.filter("k >= 10"))
    assert len(whole) == 6
    assert all(math.isclose(whole[c], (left[c] * 10 + right[c] * 20) / 30, abs_tol=1e-12) for c in whole)


def history(spark):
    rows = [("hot", s, float((s * 37) % 101)) for s in range(300)]
    rows += [("flat", s, 1.0) for s in range(20)] + [("up", s, float(s)) for s in range(20)] + [("one", 5, 2.0)]
    rows += [("gap", 1, None), ("gap", 2, 3.0), ("gap", 3, None), ("gap", 4, 4.0)]
    return rows, spark.createDataFrame(rows, "run string, step long, v double")


@pytest.mark.parametrize("slices", [1, 3, 8, 500])
def test_best_checkpoint_matches_a_running_maximum(spark, slices):
    rows, df = history(spark)
    want, best = set(), {}
    for run, step, value in sorted(r for r in rows if r[2] is not None):
        if run not in best or value > best[run][1]:
            best[run] = (step, value)
            want.add((run, step))
    got = runs.best_checkpoint(df, "run", "step", "v", slices).collect()
    assert {(r["run"], r["step"]) for r in got} == want and len(got) == len(want)
    assert {(r["run"], r["step"]) for r in got if r["kept"]} == {(run, s) for run, (s, _) in best.items()}


def test_scale_factor(spark):
    df = spark.createDataFrame([("a", 31, 6.0), ("a", 1, 3.0), ("b", 1, 0.0)], "run string, m int, dt double")
    got = {(r["run"], r["m"]): r["scale"] for r in runs.scale_factor(df, "run", "m", "dt").collect()}
    assert got == {("a", 31): 2.0, ("a", 1): 1.0, ("b", 1): None}


def test_nan_is_never_best(spark):
    df = spark.createDataFrame([("r", 1, 0.5), ("r", 2, float("nan")), ("r", 3, 0.7)], "run string, step int, v double")
    got = {r["step"]: r["kept"] for r in runs.best_checkpoint(df, "run", "step", "v").collect()}
    assert got == {1: False, 3: True}


def test_runlog_restart_replaces_its_own_run(spark, tmp_path):
    for run, m, restart in (("a", 1, True), ("a", 2, False), ("b", 1, True), ("a", 9, True)):
        line = spark.createDataFrame([(run, m, 1.0, 0.5)], "run string, " + runlogs.LOG_SCHEMA)
        runlogs.runlog_append(line, str(tmp_path / "log"), restart=restart)
    found = runlogs.runlog_read(spark, str(tmp_path / "log"))
    assert sorted((r["run"], r["m"]) for r in found.collect()) == [("a", 9), ("b", 1)]


def test_best_checkpoint_of_nothing(spark):
    df = spark.createDataFrame([], "run string, step long, v double")
    assert runs.best_checkpoint(df, "run", "step", "v").count() == 0


def test_history_long_and_sizes(spark):
    df = spark.createDataFrame([(1, 0.5, 0.4)], "epoch int, accuracy double, loss double")
    long = runs.history_long(df, "epoch", ["accuracy", "loss"])
    assert sorted(map(tuple, long.collect())) == [(1, "accuracy", 0.5), (1, "loss", 0.4)]
    size = runs.dataset_size(spark.createDataFrame([(301,)], "m int"), "m").first()
    assert size["size_bits"] == 301 * 32561 * 14 * 32 and math.isclose(size["size_mb"], 301 * 1.272824)


def test_cached_frames_are_released(spark):
    df = spark.range(10)
    with cached(df) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not df.is_cached


def test_bad_lines_have_a_channel(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("1, 2.5, a\n\n x, 3.5, b\n2, , \n3, n/a, c\n4, 1.0\n5, 1.0, d, e\n  \n|1x3 Cross validator\ny, z, q\n")
    good, bad = tables.csv_scan_checked(spark, str(path), "a int, b double, c string")
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2.5, "a"), (2, None, None)]
    found = {r["line"].strip(): r["failing"] for r in bad.collect()}
    assert found == {
        "x, 3.5, b": "a", "3, n/a, c": "b", "4, 1.0": tables.FIELDS, "5, 1.0, d, e": tables.FIELDS,
        "|1x3 Cross validator": tables.FIELDS, "y, z, q": "a",
    }
    assert all(r["path"].endswith("lines.csv") for r in bad.collect())


def test_good_census_lines_are_all_there(spark, census_csv):
    good, bad = tables.csv_scan_checked(spark, census_csv)
    assert bad.count() == 0
    assert sorted(map(tuple, good.collect()), key=str) == sorted(map(tuple, tables.csv_scan_schema(spark, census_csv).collect()), key=str)


def png(cells) -> bytes:
    """A picture of (h, w, c) bytes, c being 1 or 3."""
    h, w, c = cells.shape

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    lines = b"".join(b"\0" + row.tobytes() for row in cells)
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def test_images_are_decoded_and_others_told(spark, tmp_path):
    rng = np.random.default_rng(2)
    pictures = {f"p{i}.png": rng.integers(0, 256, shape).astype(np.uint8) for i, shape in enumerate([(4, 6, 3), (5, 3, 1), (1, 1, 3)])}
    for name, cells in pictures.items():
        (tmp_path / name).write_bytes(png(cells))
    (tmp_path / "broken.png").write_bytes(b"\x89PNG\r\n\x1a\nnothing")
    (tmp_path / "text.txt").write_text("no image")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in tables.decoded_images(spark, str(tmp_path)).collect()}
    assert set(rows) == {*pictures, "broken.png", "text.txt"}
    for name, cells in pictures.items():
        row = rows[name]
        assert (row["height"], row["width"], row["channels"]) == cells.shape and row["pixels"] == cells.ravel().tolist()
    assert all(rows[name]["pixels"] is None and rows[name]["height"] is None for name in ("broken.png", "text.txt"))
    assert tables.decoded_images(spark, str(tmp_path), "*.txt").count() == 1


def test_committed_rungs_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "log")

    def commit(run, m, dt):
        runlogs.runlog_commit(spark.createDataFrame([(run, m, dt, 0.5)], "run string, m int, dt double, a double"), path)

    for run, m, dt in (("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0), ("a", 1, 4.0)):
        commit(run, m, dt)
    with ThreadPoolExecutor(4) as pool:  # studies that write at once
        list(pool.map(lambda k: commit(f"c{k}", 7, float(k)), range(4)))
    rows = sorted((r["run"], r["m"], r["dt"], r["a"]) for r in runlogs.runlog_read(spark, path).collect())
    assert rows == [("a", 1, 4.0, 0.5), ("a", 2, 2.0, 0.5), ("b", 1, 3.0, 0.5), *((f"c{k}", 7, float(k), 0.5) for k in range(4))]
