"""Model fits: small ones that SQL can follow, and large ones that the tests check."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rungwise.checks.inputs import CLASSES, THRESHOLD, census_parts, hash_sql, rank_sql, table
from rungwise.checks.registry import query
from rungwise.operators.columns import feature_layout
from rungwise.operators.splits import FOLD_DRAW, hash_split
from rungwise.plans import dense, network, prepare, trees
from rungwise.plans.nodes import TreeTable
from rungwise.plans.prepare import FEATURES, INDEXED_LABEL
from rungwise.session import cached

PIXELS = 64


# A label that follows the price, with another border for urgent orders, but for every fifth order; the price in
# ten steps and the priority are the two features, so that a tree's candidates are few sums at every node.
def stepped(spark, sf_dir):
    priority = F.substring("o_orderpriority", 1, 1).cast("double")
    high = F.col("o_totalprice") > F.when(priority <= 2, 0.6 * THRESHOLD).otherwise(THRESHOLD)
    label = F.when(F.col("o_orderkey") % 5 == 0, ~high).otherwise(high).cast("int")
    step = F.floor(F.col("o_totalprice") / 60_000).cast("double")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", step.alias("step"), priority.alias("priority"), label.alias(INDEXED_LABEL))
    vectors = VectorAssembler(inputCols=["step", "priority"], outputCol=FEATURES).transform(rows)
    classes = {"ml_attr": {"type": "nominal", "name": INDEXED_LABEL, "vals": ["0", "1"]}}
    return vectors.select("o_orderkey", FEATURES, F.col(INDEXED_LABEL).alias(INDEXED_LABEL, metadata=classes))


def stepped_parts(spark, sf_dir):
    return hash_split(stepped(spark, sf_dir), "o_orderkey")


STEPPED = f"""stepped AS (
    SELECT o_orderkey, floor(o_totalprice / 60000) AS step, left(o_orderpriority, 1)::DOUBLE AS priority,
           CAST((o_totalprice > CASE WHEN left(o_orderpriority, 1) <= '2' THEN 0.6 * {THRESHOLD} ELSE {THRESHOLD} END)
                <> (o_orderkey % 5 = 0) AS INTEGER) AS label FROM orders),
train AS (SELECT * FROM stepped WHERE {hash_sql("o_orderkey")} < 0.7 * 4294967296),
test AS (SELECT * FROM stepped WHERE {hash_sql("o_orderkey")} >= 0.7 * 4294967296)"""


def grown_sql(train: str, test: str, depth: int, prefix: str = "", pruned: bool = True) -> str:
    """Common table expressions: a tree grown level by level on ``train`` by Gini gain, and ``test`` walked down it.

    ``best<l>`` has the splits of level l by node (its path of L and R), ``share<l>`` the nodes' label shares and rows,
    ``walked<l>`` the test rows with their node after l levels. ``pruned``: a split goes if both its nodes are leaves
    that predict alike, and ``kept<l>`` are the splits that stay; otherwise ``walked`` follows all.
    """
    p, below = prefix, "CASE feature WHEN 0 THEN step ELSE priority END <= threshold"

    def gini(n, ones):
        return f"(1 - ({n} - {ones}) / {n} * (({n} - {ones}) / {n}) - {ones} / {n} * ({ones} / {n}))"

    gain = f"{gini('n', 'ones')} - ln / n * {gini('ln', 'lo')} - (n - ln) / n * {gini('(n - ln)', '(ones - lo)')}"
    parts = [
        f"{p}at0 AS (SELECT step, priority, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS ones, '' AS node FROM {train} GROUP BY step, priority)",
        f"""{p}cuts AS (
        SELECT 0 AS feature, (step + lead(step) OVER (ORDER BY step)) / 2 AS threshold FROM (SELECT DISTINCT step FROM {train})
        UNION ALL SELECT 1, (priority + lead(priority) OVER (ORDER BY priority)) / 2 FROM (SELECT DISTINCT priority FROM {train}))""",
    ]
    for l in range(depth):
        parts += [
            f"""{p}best{l} AS (
        SELECT node, feature, threshold FROM (
            SELECT *, {gain} AS gain FROM (
                SELECT node, feature, threshold, sum(n) AS n, sum(ones) AS ones, sum(CASE WHEN {below} THEN n ELSE 0 END) AS ln,
                       sum(CASE WHEN {below} THEN ones ELSE 0 END) AS lo
                FROM {p}at{l}, {p}cuts WHERE threshold IS NOT NULL AND length(node) = {l} GROUP BY node, feature, threshold)
            WHERE ln > 0 AND ln < n)
        WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, threshold) = 1)""",
            f"""{p}at{l + 1} AS (
        SELECT step, priority, n, ones, a.node || CASE WHEN b.node IS NULL THEN '' WHEN {below} THEN 'L' ELSE 'R' END AS node
        FROM {p}at{l} a LEFT JOIN {p}best{l} b USING (node))""",
        ]
    for l in range(depth + 1):
        parts.append(f"{p}share{l} AS (SELECT node, sum(ones) / sum(n) AS p, sum(n)::BIGINT AS n FROM {p}at{l} WHERE length(node) = {l} GROUP BY node)")
    for l in reversed(range(depth)):
        deeper = f" OR EXISTS (SELECT 1 FROM {p}kept{l + 1} c WHERE c.node[:-2] = b.node)" if l + 1 < depth else ""
        parts.append(f"""{p}kept{l} AS (
        SELECT b.* FROM {p}best{l} b JOIN {p}share{l + 1} l ON l.node = b.node || 'L' JOIN {p}share{l + 1} r ON r.node = b.node || 'R'
        WHERE (l.p > 0.5) <> (r.p > 0.5){deeper})""")
    parts.append(f"{p}walked0 AS (SELECT *, '' AS node FROM {test})")
    for l in range(depth):
        parts.append(f"""{p}walked{l + 1} AS (
        SELECT w.* EXCLUDE (node), w.node || CASE WHEN b.node IS NULL THEN '' WHEN {below} THEN 'L' ELSE 'R' END AS node
        FROM {p}walked{l} w LEFT JOIN {p}{'kept' if pruned else 'best'}{l} b USING (node))""")
    shares = " UNION ALL ".join(f"SELECT * FROM {p}share{l}" for l in range(depth + 1))
    parts.append(f"{p}shares AS ({shares})")
    return ",\n    ".join(parts)


def scored_sql(depth: int, prefix: str = "") -> str:
    """Test rows with ``p``, the share of their node, and ``prediction``."""
    return f"""(SELECT w.*, p, CAST(p > 0.5 AS INTEGER)::DOUBLE AS prediction
        FROM {prefix}walked{depth} w JOIN {prefix}shares USING (node))"""


TREE = f"WITH {STEPPED}, {grown_sql('train', 'test', 2)}"


@query(
    "tree_fit",
    f"""{TREE}, nodes AS (
        SELECT '' AS path UNION ALL SELECT node || side FROM (SELECT node FROM kept0 UNION ALL SELECT node FROM kept1), (VALUES ('L'), ('R')) AS s(side))
    SELECT path, coalesce(feature, -1)::INTEGER AS feature, coalesce(threshold, 0)::DOUBLE AS threshold, round(p, 6) AS share, n AS rows
    FROM nodes JOIN shares ON shares.node = path
    LEFT JOIN (SELECT * FROM kept0 UNION ALL SELECT * FROM kept1) k ON k.node = path""",
)
def tree_fit(spark, sf_dir):
    train, _ = stepped_parts(spark, sf_dir)
    nodes = TreeTable.of(trees.tree_fit(train, depth=2)).table(spark)
    rows = F.aggregate("counts", F.lit(0.0), lambda total, n: total + n)
    share = F.round(F.get("counts", F.lit(1)) / rows, 6)
    return nodes.select("path", "feature", "threshold", share.alias("share"), rows.cast("long").alias("rows"))


@query("tree_score", f'{TREE} SELECT o_orderkey, label AS "indexedLabel", prediction FROM {scored_sql(2)}')
def tree_score(spark, sf_dir):
    train, test = stepped_parts(spark, sf_dir)
    return trees.tree_score(trees.tree_fit(train, depth=2), test, ["o_orderkey"])


# The same rows through the table of nodes.
@query("tree_score_table", f'{TREE} SELECT o_orderkey, round(p, 6) AS share, prediction FROM {scored_sql(2)}')
def tree_score_table(spark, sf_dir):
    train, test = stepped_parts(spark, sf_dir)
    scored = TreeTable.of(trees.tree_fit(train, depth=2)).score(test)
    return scored.select("o_orderkey", F.round(F.get("probability", F.lit(1)), 6).alias("share"), "prediction")


@query(
    "holdout_eval",
    f"""{TREE} SELECT count(*) AS rows, round(avg(-ln(CASE WHEN label = 1 THEN p ELSE 1 - p END)), 6) AS loss,
           round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM {scored_sql(2)}""",
)
def holdout_eval(spark, sf_dir):
    train, test = stepped_parts(spark, sf_dir)
    result = trees.holdout_eval(trees.tree_fit(train, depth=2), test, classes=2)
    return result.withColumns({c: F.round(c, 6) for c in ("loss", "accuracy")})


FOLD = f"CAST(floor({hash_sql('o_orderkey', draw=FOLD_DRAW)} * 3 / 4294967296) AS INTEGER)"
DEPTHS = (1, 2, 3)
FOLDS = ", ".join(
    f"train{k} AS (SELECT * FROM folded WHERE fold <> {k}), test{k} AS (SELECT * FROM folded WHERE fold = {k}), "
    + grown_sql(f"train{k}", f"test{k}", max(DEPTHS), f"f{k}_", pruned=False)
    for k in range(3)
)
FOLD_SHARES = " UNION ALL ".join(
    f"SELECT {d} AS depth, {k} AS fold, avg(CAST(label = prediction AS INTEGER)) AS a FROM {scored_sql(d, f'f{k}_')}"
    for d in DEPTHS for k in range(3)
)


@query(
    "cross_validate",
    f"""WITH {STEPPED}, folded AS (SELECT *, {FOLD} AS fold FROM train), {FOLDS},
    means AS (SELECT depth, avg(a) AS accuracy FROM ({FOLD_SHARES}) GROUP BY depth)
    SELECT depth, round(accuracy, 6) AS accuracy, row_number() OVER (ORDER BY round(accuracy, 12) DESC, depth) = 1 AS best, true AS timed FROM means""",
)
def cross_validate(spark, sf_dir):
    train, _ = stepped_parts(spark, sf_dir)
    found = trees.cross_validate(train, "o_orderkey", depths=DEPTHS, folds=3, copies=251)
    return found.select("depth", F.round("accuracy", 6).alias("accuracy"), "best", (F.col("seconds") > 0).alias("timed"))


@query(
    "train_eval_ladder",
    f"""{TREE} SELECT CAST(m AS INTEGER) AS m, m * (SELECT count(*) FROM train) AS rows,
           (SELECT round(avg(CAST(label = prediction AS INTEGER)), 6) FROM {scored_sql(2)}) AS a, true AS timed
    FROM range(1, 21, 5) AS r(m)""",
)
def train_eval_ladder(spark, sf_dir):
    train, test = stepped_parts(spark, sf_dir)
    rungs = trees.train_eval_ladder(train, test, max_m=20, step=5, depth=2)
    return rungs.select("m", "rows", F.round("a", 6).alias("a"), (F.col("dt") > 0).alias("timed"))


# A fitted pipeline on categories it has never seen, in columns with different numbers of them: each column's own next rank.
@query(
    "prepare_unseen",
    f"""WITH known AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0)
    SELECT o_orderkey,
           coalesce(s.rank, (SELECT count(DISTINCT o_orderstatus) FROM known))::INTEGER AS status,
           coalesce(p.rank, (SELECT count(DISTINCT o_orderpriority) FROM known))::INTEGER AS priority
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus,
                 CASE WHEN o_orderkey % 14 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'new' ELSE o_orderpriority END AS o_orderpriority FROM orders) o
    LEFT JOIN {rank_sql("known", "o_orderstatus")} s ON s.o_orderstatus = o.o_orderstatus
    LEFT JOIN {rank_sql("known", "o_orderpriority")} p ON p.o_orderpriority = o.o_orderpriority""",
)
def prepare_unseen(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_totalprice") > THRESHOLD).cast("string").alias("label")
    )
    odd = F.col("o_orderkey") % 7 == 0
    layout = feature_layout(orders, key="o_orderkey")
    model = prepare.fit_features(orders.filter(~odd), layout)
    changed = orders.withColumn("o_orderstatus", F.when(odd, "new").otherwise(F.col("o_orderstatus")))
    priority = F.when(F.col("o_orderkey") % 14 == 0, F.lit(None)).when(odd, "new").otherwise(F.col("o_orderpriority"))
    ready = prepare.apply_features(model, changed.withColumn("o_orderpriority", priority), layout, ["o_orderkey"])
    cells = vector_to_array(FEATURES)
    return ready.select("o_orderkey", *(F.get(cells, F.lit(i)).cast("int").alias(name) for i, name in enumerate(("status", "priority"))))


# The same at the reference's depth on the census shape: too large for SQL, checked by the tests.
@query("tree_fit_deep")
def tree_fit_deep(spark, sf_dir):
    train, _, features = census_parts(spark, sf_dir)
    with cached(trees.spread_rows(train)) as rows:
        return trees.tree_importances(trees.tree_fit(rows), features)


@query("tree_score_deep")
def tree_score_deep(spark, sf_dir):
    train, test, _ = census_parts(spark, sf_dir)
    with cached(trees.spread_rows(train)) as rows:
        model = trees.tree_fit(rows)
    return trees.tree_score(model, test, ["o_orderkey"])


@query("holdout_eval_deep")
def holdout_eval_deep(spark, sf_dir):
    train, test, _ = census_parts(spark, sf_dir)
    with cached(trees.spread_rows(train)) as rows:
        model = trees.tree_fit(rows)
    return trees.holdout_eval(model, test, classes=2)


@query("cross_validate_deep")
def cross_validate_deep(spark, sf_dir):
    train, _, _ = census_parts(spark, sf_dir)
    return trees.cross_validate(train, "o_orderkey", copies=2)


@query("train_eval_ladder_deep")
def train_eval_ladder_deep(spark, sf_dir):
    train, test, _ = census_parts(spark, sf_dir)
    return trees.train_eval_ladder(train, test, max_m=20, step=5)


def image_parts(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return hash_split(df, "vec_id")


# A label that one value decides, so that a dense network must find it.
@query(
    "mlp_fit",
    f"""SELECT count(*) AS rows, 64 * 8 + 8 + 8 * 2 + 2 AS weights, true AS shares_sum_to_one, true AS learnt
    FROM embeddings WHERE {hash_sql("vec_id")} >= 0.7 * 4294967296""",
)
def mlp_fit(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").withColumn("label", (F.get("embedding", F.lit(0)) > 0).cast("int"))
    train, test = (dense.array_examples(part, "embedding", "label") for part in hash_split(df, "vec_id"))
    with cached(train) as rows:
        model = dense.mlp_fit(rows, PIXELS, 2, hidden=(8,))
    scored = model.transform(test).withColumn("p", vector_to_array("probability"))
    whole = F.abs(F.aggregate("p", F.lit(0.0), lambda a, v: a + v) - 1) < 1e-9
    right = F.avg((F.col("prediction") == F.col("label")).cast("int"))
    return scored.agg(
        F.count("*").alias("rows"), F.lit(len(model.weights)).alias("weights"),
        F.bool_and(whole).alias("shares_sum_to_one"), (right > 0.8).alias("learnt"),
    )


@query("mlp_fit_images")
def mlp_fit_images(spark, sf_dir):
    train, test = (dense.array_examples(part, "embedding", "label") for part in image_parts(spark, sf_dir))
    with cached(train) as rows:
        model = dense.mlp_fit(rows, PIXELS, CLASSES)
    scored = trees.holdout_eval(model, test, CLASSES)
    return scored.withColumn("weights", F.lit(len(model.weights)))


# One epoch of one batch from zero weights: the first loss is ln 10, and one Adam step is SQL.
@query(
    "softmax_fit",
    f"""WITH cells AS (
        SELECT vec_id, label, {hash_sql("vec_id")} < 0.7 * 4294967296 AS train, j,
               CASE WHEN j = 65 THEN 1.0 ELSE embedding[j]::DOUBLE END AS x
        FROM embeddings, range(1, 66) AS r(j)),
    slopes AS (
        SELECT c, j, greatest(-0.12, least(0.12, avg((0.1 - 0.02 - CASE WHEN label = c THEN 0.8 ELSE 0 END) * x))) AS g
        FROM cells, range(10) AS k(c) WHERE train GROUP BY c, j),
    weights AS (SELECT c, j, -0.005 * g / (abs(g) + 1e-7) AS w FROM slopes),
    logits AS (
        SELECT vec_id, label, c, sum(w * x) AS z FROM cells JOIN weights USING (j) WHERE NOT train GROUP BY vec_id, label, c),
    logs AS (SELECT *, z - ln(sum(exp(z)) OVER (PARTITION BY vec_id)) AS l,
                    row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, c) AS place FROM logits),
    rows AS (
        SELECT vec_id, -sum((CASE WHEN label = c THEN 0.8 ELSE 0 END + 0.02) * l) AS loss,
               max(CAST(place = 1 AND label = c AS INTEGER)) AS hit FROM logs GROUP BY vec_id)
    SELECT 1 AS epoch, round(ln(10), 6) AS loss,
           (SELECT round(avg(CAST(label = 0 AS INTEGER)), 6) FROM cells WHERE train AND j = 1) AS accuracy,
           round(avg(loss), 6) AS val_loss, round(avg(hit), 6) AS val_accuracy FROM rows""",
)
def softmax_fit(spark, sf_dir):
    train, valid = image_parts(spark, sf_dir)
    _, history = dense.softmax_fit(
        train, valid, "vec_id", "embedding", "label", PIXELS, CLASSES, epochs=1, batch_size=1 << 40
    )
    return history.select("epoch", *[F.round(c, 6).alias(c) for c in ("loss", "accuracy", "val_loss", "val_accuracy")])


@query("softmax_fit_batches")
def softmax_fit_batches(spark, sf_dir):
    train, valid = image_parts(spark, sf_dir)
    _, history = dense.softmax_fit(train, valid, "vec_id", "embedding", "label", PIXELS, CLASSES, batch_size=64)
    return history


# One step through a rectified hidden layer of four units from given weights: back-propagation and Adam in SQL.
UNITS = 4
SIZES = (PIXELS, UNITS, CLASSES)
FIRST, SECOND = "((h * 31 + j * 17) % 13 - 6) / 50.0::DOUBLE", "((c * 7 + h * 5) % 11 - 5) / 20.0::DOUBLE"


def given_weights():
    flat = np.zeros(network.weight_count(SIZES))
    one, two = network.layer_views(flat, SIZES)
    one[:, :-1] = [[((h * 31 + j * 17) % 13 - 6) / 50.0 for j in range(1, PIXELS + 1)] for h in range(UNITS)]
    two[:, :-1] = [[((c * 7 + h * 5) % 11 - 5) / 20.0 for h in range(UNITS)] for c in range(CLASSES)]
    return flat


def forward_sql(name: str, one: str, two: str) -> str:
    """``<name>_hidden`` (with the bias as unit 4) and ``<name>_logs``: logarithms of the class shares by row and class."""
    return f"""{name}_units AS (SELECT vec_id, label, train, h, greatest(sum(w * x), 0) AS a FROM cells JOIN {one} USING (j) GROUP BY vec_id, label, train, h),
    {name}_hidden AS (SELECT * FROM {name}_units UNION ALL SELECT DISTINCT vec_id, label, train, {UNITS}, 1.0 FROM cells),
    {name}_scores AS (SELECT vec_id, label, train, c, sum(w * a) AS z FROM {name}_hidden JOIN {two} USING (h) GROUP BY vec_id, label, train, c),
    {name}_logs AS (SELECT *, z - ln(sum(exp(z)) OVER (PARTITION BY vec_id)) AS l, row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, c) AS place FROM {name}_scores)"""


def figures_sql(name: str, part: str) -> str:
    return f"""(SELECT round(-sum((CASE WHEN label = c THEN 0.8 ELSE 0 END + 0.02) * l) / count(DISTINCT vec_id), 6) AS loss,
        round(sum(CAST(place = 1 AND label = c AS INTEGER)) / count(DISTINCT vec_id), 6) AS accuracy FROM {name}_logs WHERE {part})"""


STEP = "w - 0.005 * greatest(-0.12, least(0.12, g)) / (abs(greatest(-0.12, least(0.12, g))) + 1e-7)"


@query(
    "network_fit",
    f"""WITH cells AS (
        SELECT vec_id, label, {hash_sql("vec_id")} < 0.7 * 4294967296 AS train, j,
               CASE WHEN j = {PIXELS + 1} THEN 1.0 ELSE embedding[j]::DOUBLE END AS x FROM embeddings, range(1, {PIXELS + 2}) AS r(j)),
    one AS (SELECT h, j, CASE WHEN j = {PIXELS + 1} THEN 0 ELSE {FIRST} END AS w FROM range({UNITS}) AS a(h), range(1, {PIXELS + 2}) AS b(j)),
    two AS (SELECT c, h, CASE WHEN h = {UNITS} THEN 0 ELSE {SECOND} END AS w FROM range({CLASSES}) AS a(c), range({UNITS + 1}) AS b(h)),
    {forward_sql("before", "one", "two")},
    deltas AS (SELECT vec_id, c, exp(l) - 0.02 - CASE WHEN label = c THEN 0.8 ELSE 0 END AS d FROM before_logs WHERE train),
    slopes2 AS (SELECT c, h, avg(d * a) AS g FROM deltas JOIN before_hidden USING (vec_id) GROUP BY c, h),
    back AS (SELECT vec_id, h, sum(d * w) * CAST(any_value(a) > 0 AS INTEGER) AS d
             FROM deltas JOIN two USING (c) JOIN before_units USING (vec_id, h) GROUP BY vec_id, h),
    slopes1 AS (SELECT h, j, avg(d * x) AS g FROM back JOIN cells USING (vec_id) GROUP BY h, j),
    one_after AS (SELECT h, j, {STEP} AS w FROM one JOIN slopes1 USING (h, j)),
    two_after AS (SELECT c, h, {STEP} AS w FROM two JOIN slopes2 USING (c, h)),
    {forward_sql("after", "one_after", "two_after")}
    SELECT 1 AS epoch, t.loss, t.accuracy, v.loss AS val_loss, v.accuracy AS val_accuracy
    FROM {figures_sql("before", "train")} t, {figures_sql("after", "NOT train")} v""",
)
def network_fit(spark, sf_dir):
    train, valid = image_parts(spark, sf_dir)
    _, history = network.network_fit(
        train, valid, "vec_id", "embedding", "label", PIXELS, CLASSES, hidden=(UNITS,), epochs=1, batch_size=1 << 40,
        initial=given_weights(),
    )
    return history.select("epoch", *[F.round(c, 6).alias(c) for c in ("loss", "accuracy", "val_loss", "val_accuracy")])


@query("network_fit_images")
def network_fit_images(spark, sf_dir):
    train, valid = image_parts(spark, sf_dir)
    _, history = network.network_fit(train, valid, "vec_id", "embedding", "label", PIXELS, CLASSES, hidden=(512,))
    return history
