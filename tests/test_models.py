"""Trees, cross-validation, ladders and dense models."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rungwise.functions.hashing import FOLD, LOW_32, hash_constant, mixed
from rungwise.operators.columns import feature_layout
from rungwise.operators.growth import bag_multiply
from rungwise.operators.metrics import accuracy, mean_gradient
from rungwise.operators.splits import hash_split, kfold_assign
from rungwise.plans import dense, network, prepare, trees
from rungwise.plans.nodes import TreeTable, tree_roundtrip
from rungwise.plans.prepare import INDEXED_LABEL
from rungwise.plans.scorers import TableScorer, scorer_roundtrip
from rungwise.session import cached, scratch_path
from rungwise.sources import models, tables
from rungwise.sources.runlogs import run_name, runlog_scan


@pytest.fixture(scope="module")
def parts(spark, census_csv):
    """Census fixture: the label is cut from hours_per_week, so a tree can find it."""
    raw = tables.csv_scan_schema(spark, census_csv).withColumn("key", F.monotonically_increasing_id())
    raw = raw.select("key", *raw.columns[:-1]).cache()
    layout = feature_layout(raw, key="key")
    train, test = hash_split(raw, "key")
    model = prepare.fit_features(train, layout)
    ready = [prepare.apply_features(model, part, layout, ["key"]).cache() for part in (train, test)]
    return raw, layout, model, *ready


def test_tree_finds_a_label_cut_from_a_column(spark, parts):
    _, layout, _, train, test = parts
    model = trees.tree_fit(train)
    assert accuracy(model.transform(test), INDEXED_LABEL).first()["accuracy"] > 0.95
    weights = {r["feature"]: r["importance"] for r in trees.tree_importances(model, layout.features).collect()}
    assert max(weights, key=weights.get) == "hours_per_week" and len(weights) == 14


def test_fit_is_repeatable(spark, parts):
    _, _, _, train, test = parts
    assert trees.tree_fit(train).toDebugString.split("\n")[1:] == trees.tree_fit(train).toDebugString.split("\n")[1:]


def test_tree_without_signal_stays_near_the_majority(spark):
    df = spark.range(4000).select(
        "id", ((F.col("id") * 7919) % 1009).cast("double").alias("x"), F.when(F.rand(3) < 0.6, "a").otherwise("b").alias("y")
    ).cache()
    layout = feature_layout(df, key="id")
    train, test = hash_split(df, "id")
    model = prepare.fit_features(train, layout)
    train, test = (prepare.apply_features(model, part, layout, ["id"]) for part in (train, test))
    share = accuracy(trees.tree_fit(train).transform(test), INDEXED_LABEL).first()["accuracy"]
    assert 0.5 < share < 0.66


def test_ordered_codes_fit_where_categories_do_not(spark, parts):
    raw, layout, _, train, _ = parts
    assert trees.tree_fit(train).numFeatures == 14
    marked = prepare.apply_features(prepare.fit_features(raw, layout, nominal=True), raw, layout, ["key"])
    with pytest.raises(Exception):
        trees.tree_fit(marked)
    assert trees.tree_fit(marked, bins=64).numFeatures == 14


def test_unseen_category_gets_its_own_rank(spark, parts):
    raw, layout, model, _, _ = parts
    odd = raw.limit(3).withColumn("sex", F.lit("unheard of"))
    position = layout.features.index("sex_index")
    assert {r["features"][position] for r in prepare.apply_features(model, odd, layout, ["key"]).collect()} == {2.0}
    with pytest.raises(Exception):
        prepare.apply_features(model, raw.withColumn("label", F.lit("new")), layout, ["key"]).collect()


def test_missing_number_counts_as_zero(spark, parts):
    raw, layout, model, _, _ = parts
    hole = prepare.apply_features(model, raw.filter(F.col("fnlwgt").isNull()), layout, ["key"]).first()
    assert hole["features"][layout.features.index("fnlwgt")] == 0.0


def test_single_class_table(spark):
    df = spark.range(50).select("id", F.col("id").cast("double").alias("x"), F.lit("only").alias("y"))
    layout = feature_layout(df, key="id")
    ready = prepare.apply_features(prepare.fit_features(df, layout), df, layout, ["id"])
    model = trees.tree_fit(ready)
    assert accuracy(model.transform(ready), INDEXED_LABEL).first()["accuracy"] == 1.0


def test_saved_scorer_scores_alike(spark, parts):
    raw, _, features, train, _ = parts
    scorer = prepare.scorer(features, trees.tree_fit(train))
    result = models.model_roundtrip(raw.na.fill(0), scorer, scratch_path(spark, "model")).first()
    assert result["rows"] == raw.count() and result["differing"] == 0


def test_difference_is_noticed(spark, parts):
    raw, _, features, train, _ = parts
    one, other = (prepare.scorer(features, trees.tree_fit(train, depth=d)) for d in (0, 5))
    assert models.score_difference(raw.na.fill(0), one, other).first()["differing"] > 0


def test_cross_validation_marks_one_best_depth(spark, parts):
    _, _, _, train, _ = parts
    rows = trees.cross_validate(train, "key", depths=(1, 3), folds=3, copies=2).collect()
    assert [r["depth"] for r in rows] == [1, 3] and sum(r["best"] for r in rows) == 1
    best = max(rows, key=lambda r: r["accuracy"])
    assert best["best"] and best["accuracy"] > 0.9 and best["seconds"] > 0


def test_deep_trees_get_no_more_partitions_than_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(trees, "FEWEST", 10)
    rows = spark.range(40 * cores).toDF("id")
    assert trees.spread_rows(rows).rdd.getNumPartitions() > cores
    spread, at_once = trees.spread_few(rows, 4)
    assert spread.rdd.getNumPartitions() == cores and at_once == 4 and spread.count() == 40 * cores
    assert trees.spread_few(spark.range(0), 4)[0].rdd.getNumPartitions() == 1
    monkeypatch.setattr(trees, "MOST", 20)
    assert trees.spread_few(rows, 4)[1] == 2  # the fits at once keep as many rows as fit, whatever the table
    monkeypatch.setattr(trees, "MOST", 1)
    assert trees.spread_few(rows, 4)[1] == 1


def test_cross_validation_of_many_copies_keeps_one_base(spark, parts, monkeypatch):
    _, _, _, train, test = parts
    kept = []
    monkeypatch.setattr(trees, "cached", lambda *frames: kept.extend(frames) or cached(*frames))
    search = trees.cross_validator(train, "key", depths=(1,), folds=2, copies=251)
    assert [df.count() for df in kept] == [train.count()] and search.seconds > 0
    assert accuracy(search.model.transform(test), INDEXED_LABEL).first()["accuracy"] > 0.9


def test_ladder_rows_grow_and_accuracy_stays(spark, parts):
    _, _, _, train, test = parts
    rows = trees.train_eval_ladder(train, test, max_m=25, step=12).collect()
    base = train.count()
    assert [(r["m"], r["rows"]) for r in rows] == [(m, base * m) for m in (1, 13, 25)]
    assert all(r["dt"] > 0 and r["a"] > 0.95 for r in rows)


def test_ladder_logs_every_rung(spark, parts):
    _, _, _, train, test = parts
    path = scratch_path(spark, "ladder")
    rows = trees.train_eval_ladder(train, test, max_m=4, step=2, log=path, run=run_name(4, 10, 8)).collect()
    logged = runlog_scan(spark, f"{path}/*").orderBy("m").collect()
    assert [tuple(r) for r in logged] == [(r["m"], r["dt"], r["a"], 4, 10, 8) for r in rows]


def toy_images(spark, n=240):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(n):
        label = k % 3
        x = rng.normal(0, 0.3, 4)
        x[label] += 2.0
        rows.append((k, [float(v) for v in x], label))
    return spark.createDataFrame(rows, "k long, x array<float>, y int")


def test_softmax_learns_and_reports_every_epoch(spark):
    train, valid = hash_split(toy_images(spark), "k")
    model, history = dense.softmax_fit(
        train, valid, "k", "x", "y", inputs=4, classes=3, epochs=3, batch_size=32, rate=0.1, smoothing=0.0
    )
    rows = history.collect()
    assert [r["epoch"] for r in rows] == [1, 2, 3] and model.weights.shape == (3, 5)
    scored = model.score(valid, "x")
    right = scored.filter("prediction = y").count() / valid.count()
    assert abs(right - max(r["val_accuracy"] for r in rows)) < 1e-12
    path = scratch_path(spark, "softmax")
    assert dense.softmax_roundtrip(valid, model, "x", path).first().asDict() == {"rows": valid.count(), "differing": 0}
    assert rows[-1]["loss"] < rows[0]["loss"] and rows[-1]["val_accuracy"] > 0.9


def test_softmax_on_an_empty_table(spark):
    empty = toy_images(spark).filter("k < 0")
    model, history = dense.softmax_fit(empty, empty, "k", "x", "y", 4, 3, epochs=1)
    assert not model.weights.any() and history.first()["loss"] is None


def test_rows_that_do_not_fit_are_left_out(spark):
    rows = [([1.0] * 4, 0), ([1.0] * 3, 1), (None, 1), ([2.0] * 4, None), ([2.0] * 4, -1), ([2.0] * 4, 3)]
    df = spark.createDataFrame(rows, "x array<float>, y int")
    assert network.evaluated(df, "x", "y", np.zeros(15), (4, 3), 0.0)[2] == 1


def test_gradient_sums_match_the_aggregate(spark):
    df = toy_images(spark, 60).withColumn("p", F.array_repeat(F.lit(1 / 3), 3))
    rows = df.collect()
    sums = network.batch_sums(np.zeros(15), (4, 3), np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]), 0.0)
    assert sums[-1] == 60
    for r in mean_gradient(df, "x", "p", "y", 3).collect():
        assert np.isclose(sums[r["class"] * 5 + r["position"]] / 60, r["gradient"])


@pytest.mark.parametrize("sizes", [(4, 3), (4, 6, 3), (4, 5, 7, 3)])
def test_gradient_equals_finite_differences(sizes):
    rng = np.random.default_rng(3)
    flat = rng.normal(0, 0.5, network.weight_count(sizes))
    x, y = rng.normal(0, 1, (20, 4)), rng.integers(0, 3, 20)
    sums = network.batch_sums(flat, sizes, x, y, 0.2)
    for place in range(len(flat)):
        step = np.zeros(len(flat))
        step[place] = 1e-6
        high, low = (network.batch_sums(flat + s, sizes, x, y, 0.2, slopes=False)[-3] for s in (step, -step))
        assert abs((high - low) / 2e-6 - sums[place]) < 1e-4


def trained_by_hand(rows, valid, sizes, epochs, batch_size, per_block, smoothing=0.2, rate=0.005, clip=0.12, seed=42):
    """The same training in one process: batches in the stored order, epochs in the order of the hashes of block and batch."""
    flat, adam, history = network.initial_weights(sizes, seed), network.Adam(rate, clip), []
    batches = -(-len(rows) // batch_size)
    for epoch in range(1, epochs + 1):
        seen, number = np.zeros(3), seed + epoch
        for batch in sorted(range(batches), key=lambda b: (mixed(b // per_block ^ hash_constant(number, 1)), hashed(b, number), b)):
            own = rows[batch * batch_size : (batch + 1) * batch_size]
            sums = network.batch_sums(flat, sizes, np.array([r[1] for r in own]), np.array([r[2] for r in own]), smoothing)
            flat, seen = adam.update(flat, sums[:-3] / sums[-1]), seen + sums[-3:]
        held = network.batch_sums(flat, sizes, np.array([r[1] for r in valid]), np.array([r[2] for r in valid]), smoothing, slopes=False)[-3:]
        history.append((epoch, seen[0] / seen[2], seen[1] / seen[2], held[0] / held[2], held[1] / held[2]))
    return history


def hashed(key: int, seed: int) -> int:
    folded = (key & LOW_32) ^ ((key >> 32) * FOLD & LOW_32) ^ hash_constant(seed, 0)
    return mixed(folded)


@pytest.mark.parametrize(
    "hidden, block, streamed, most", [((), 1 << 16, 4096, 1), ((6,), 48, 4096, 1), ((6,), 1 << 16, 8, 1), ((), 1 << 16, 8, 4)]
)
def test_training_follows_the_steps(spark, monkeypatch, hidden, block, streamed, most):
    monkeypatch.setattr(network, "MOST_BLOCKS", 256 if most == 1 else 3)
    monkeypatch.setattr(network, "BLOCK_ROWS", block)
    monkeypatch.setattr(network, "STREAMED", streamed)
    train, valid = hash_split(toy_images(spark), "k")
    rows = sorted(map(tuple, train.collect()), key=lambda r: (hashed(r[0], 42), r[0]))
    _, history = network.network_fit(train, valid, "k", "x", "y", 4, 3, hidden=hidden, epochs=2, batch_size=16)
    per_block = max(1, block // 16) if streamed >= 16 else most
    want = trained_by_hand(rows, list(map(tuple, valid.collect())), (4, *hidden, 3), 2, 16, per_block)
    assert np.allclose([tuple(r) for r in history.collect()], want, rtol=1e-9)


def test_an_epoch_takes_as_many_jobs_whatever_its_small_batches(spark):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for group, size in (("few", 120), ("many", 4)):
        stored = network.store_batches(toy_images(spark), "k", "x", "y", size, 42)
        spark.sparkContext.setJobGroup(group, group)
        network.train_epoch(stored, 1, np.zeros(15), network.Adam(0.01, None), (4, 3), 0.0)
        spark.sparkContext.setJobGroup("rest", "rest")
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    assert jobs[0] == jobs[1] <= 2


def test_training_goes_on_after_its_last_epoch(spark):
    train, valid = hash_split(toy_images(spark), "k")
    settings = {"hidden": (5,), "batch_size": 32}
    state = scratch_path(spark, "state")
    network.network_fit(train, valid, "k", "x", "y", 4, 3, epochs=1, state=state, **settings)
    again, resumed = network.network_fit(train, valid, "k", "x", "y", 4, 3, epochs=3, state=state, **settings)
    whole, history = network.network_fit(train, valid, "k", "x", "y", 4, 3, epochs=3, **settings)
    assert resumed.collect() == history.collect() and np.array_equal(again.flat, whole.flat)


def test_network_scores_saves_and_loads(spark):
    train, valid = hash_split(toy_images(spark), "k")
    model, history = network.network_fit(train, valid, "k", "x", "y", 4, 3, hidden=(16,), epochs=4, batch_size=16, rate=0.02, smoothing=0.0)
    odd = spark.createDataFrame([(900, None, 0), (901, [1.0], 0), (902, [1.0, None, 1.0, 1.0], 0)], "k long, x array<float>, y int")
    scored = model.score(valid.unionByName(odd), "x").collect()
    assert all(r["prediction"] is None for r in scored if r["k"] >= 900) and len(scored) == valid.count() + 3
    right = np.mean([r["prediction"] == r["y"] for r in scored if r["k"] < 900])
    assert right > 0.9 and abs(right - max(r["val_accuracy"] for r in history.collect())) < 1e-12
    path = scratch_path(spark, "network")
    model.save(spark, path)
    again = network.Network.load(spark, path)
    assert again.sizes == model.sizes and np.array_equal(again.flat, model.flat)


def test_batches_are_stored_whole(spark):
    stored = network.store_batches(toy_images(spark), "k", "x", "y", 32, 42)
    sizes = dict(stored.rows.groupBy("batch_id").count().collect())
    assert stored.order(1) == [0] and stored.batches == 8 and sorted(sizes) == list(range(8)) and sum(sizes.values()) == 240


def node_rows(tree, scale=1.0):
    return [(n.path, n.feature, n.threshold, n.categories, [c * scale for c in n.counts]) for n in tree.nodes]


def test_shallow_trees_are_prefixes_of_deep_ones(spark, parts):
    raw, _, _, train, test = parts
    deep = TreeTable.of(trees.tree_fit(train, depth=8))
    depths = [0, 1, 2, 5, 8, 12]
    nested = deep.predict_at(test, depths).orderBy("key").collect()
    for depth in depths:
        own = trees.tree_fit(train, depth=min(depth, 8)).transform(test).orderBy("key").collect()
        assert [r[f"prediction_{depth}"] for r in nested] == [r["prediction"] for r in own]
    shares = trees.nested_accuracies(deep, test, (1, 5))
    assert shares == [accuracy(trees.tree_fit(train, depth=d).transform(test), INDEXED_LABEL).first()["accuracy"] for d in (1, 5)]


def test_node_table_scores_like_the_model(spark, parts):
    raw, layout, _, train, test = parts
    for nominal in (False, True):
        features = prepare.fit_features(raw, layout, nominal=nominal)
        ready = prepare.apply_features(features, raw, layout, ["key"])
        model = trees.tree_fit(ready, depth=6, bins=64)
        table = TreeTable.of(model)
        path = scratch_path(spark, "nodes")
        table.save(spark, path)
        assert TreeTable.load(spark, path).nodes == table.nodes and any(n.categories for n in table.nodes) == nominal
        scored = table.score(ready).withColumnsRenamed({"prediction": "_own", "probability": "_shares"})
        for r in model.transform(scored).collect():
            assert r["prediction"] == r["_own"] and np.allclose(r["probability"].toArray(), r["_shares"], atol=1e-12)
        assert tree_roundtrip(ready, table, path).first().asDict() == {"rows": raw.count(), "nodes": len(table.nodes), "differing": 0}


def test_table_scorer_equals_the_pipeline(spark, parts):
    raw, layout, features, train, _ = parts
    tree = trees.tree_fit(train)
    odd = raw.na.fill(0).withColumn("sex", F.when(F.col("key") % 3 == 0, "unheard of").otherwise(F.col("sex")))
    odd = odd.withColumn("workclass", F.when(F.col("key") % 4 != 0, F.col("workclass")))
    scorer, path = TableScorer.of(features, tree, layout), scratch_path(spark, "scorer")
    result = scorer_roundtrip(odd, scorer, prepare.scorer(features, tree), path).first()
    assert result.asDict() == {"rows": raw.count(), "differing": 0}
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1


def test_unseen_ranks_and_metadata_are_each_columns_own(spark, parts):
    raw, layout, model, _, _ = parts
    known = {c: raw.filter(F.col("key") >= 0).select(c).distinct().count() for c in layout.text}
    odd = raw.limit(2).withColumns({c: F.lit("unheard of") for c in layout.text})
    row = prepare.apply_features(model, odd, layout, ["key"]).first()["features"]
    sizes = {c: len(stage.labels) for c, stage in zip(layout.text, model.stages[1:])}
    assert [row[layout.features.index(c + "_index")] for c in layout.text] == [sizes[c] for c in layout.text]
    assert len(set(sizes.values())) > 1 and all(sizes[c] <= known[c] for c in sizes)
    indexed = model.transform(raw.na.fill(0)).schema
    for c in layout.text:
        names = indexed[c + "_index"].metadata["ml_attr"]["vals"]
        assert len(names) == sizes[c] + 1 and None not in names


def test_weights_grow_the_same_tree_as_copies(spark, parts):
    _, _, _, train, _ = parts
    copied = TreeTable.of(trees.tree_fit(bag_multiply(train, 7), depth=5))
    weighed = TreeTable.of(trees.tree_fit(train.withColumn("w", F.lit(7.0)), depth=5, weightCol="w"))
    assert node_rows(copied) == node_rows(weighed)


def test_cross_validation_equals_separate_fits(spark, parts):
    _, _, _, train, _ = parts
    search = trees.cross_validator(train, "key", depths=(1, 2, 6), folds=3, copies=3)
    folded = kfold_assign(train, "key", 3).cache()
    for depth, share in zip(search.depths, search.accuracies):
        own = []
        for fold in range(3):
            model = trees.tree_fit(bag_multiply(folded.filter(F.col("fold") != fold), 3), depth=depth)
            own.append(accuracy(model.transform(folded.filter(F.col("fold") == fold)), INDEXED_LABEL).first()["accuracy"])
        assert abs(share - sum(own) / 3) < 1e-12


def test_mlp_learns(spark):
    train, test = (dense.array_examples(p, "x", "y") for p in hash_split(toy_images(spark), "k"))
    model = dense.mlp_fit(train, 4, 3, hidden=(8,))
    assert trees.holdout_eval(model, test, 3).first()["accuracy"] > 0.9
