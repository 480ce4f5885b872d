import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from spendspark.functions.numeric import hash_unit
from spendspark.operators import iforest, trees
from spendspark.operators.anomaly import anomaly_features, category_average
from spendspark.plans import scoring, training
from spendspark.plans.queries import QUERIES
from spendspark.schemas import ANOMALY_FEATURES
from spendspark.session import materialise
from spendspark.sources import synthetic
from spendspark.sources.adapters import tx_orders


@pytest.fixture(scope="module")
def points(spark):
    """A tight cloud and one far point."""
    cloud = spark.range(3000).select(
        F.col("id"), F.randn(1).alias("a"), F.randn(2).alias("b"), (F.col("id") < 0).alias("far")
    )
    far = spark.range(3000, 3010).select("id", F.lit(12.0).alias("a"), F.lit(-12.0).alias("b"), F.lit(True).alias("far"))
    return materialise(cloud.unionByName(far), "points")


@pytest.fixture(scope="module")
def forest(points):
    return iforest.fit(points, ["a", "b"], ["id"], n_trees=50)


def walk(nodes, row):
    """One row down one tree, node by node."""
    slot = 0
    while nodes[slot]["feature"] != trees.LEAF:
        node = nodes[slot]
        slot = 2 * slot + (1 if row[node["feature"]] <= node["threshold"] else 2)
    return nodes[slot]["path_length"]


def test_average_path_values():
    assert [trees.average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert trees.average_path(256) == pytest.approx(10.2448, abs=1e-4)
    assert [trees.depth_limit(n) for n in (1, 2, 3, 256, 257)] == [1, 1, 2, 8, 9]


def test_scores_equal_a_walk_node_by_node(points, forest):
    by_tree = {}
    for node in forest.nodes.collect():
        by_tree.setdefault(node["tree"], {})[node["slot"]] = node
    assert len(by_tree) == 50
    sample = points.where("id % 500 = 0 or far").withColumn("score", forest.score(F.col("a"), F.col("b")))
    for row in sample.collect():
        path = np.mean([walk(nodes, (row.a, row.b)) for nodes in by_tree.values()])
        assert row.score == pytest.approx(-(2 ** (-path / trees.average_path(256))), rel=1e-10)


def test_every_tree_holds_its_whole_sample(spark):
    rows = spark.range(60_000).select("id", F.rand(3).alias("a"))
    for n, frame in ((60_000, rows), (2000, rows.where("id < 2000")), (90, rows.where("id < 90"))):
        samples = iforest.tree_samples(frame, ["id"], n)
        counts = [r["count"] for r in samples.groupBy("tree").count().collect()]
        assert len(counts) == iforest.TREES and set(counts) == {min(256, n)}
        # Each tree draws on its own from all rows.
        drawn = samples.select("id").distinct().count()
        assert drawn == n if n < 256 else 0.9 < drawn / (n * (1 - (1 - 256 / n) ** iforest.TREES)) < 1.1


def test_repeated_keys_leave_no_tree_short(spark):
    rows = spark.range(20_000).select((F.col("id") % 60).alias("key"), F.rand(3).alias("a"))
    counts = {r["count"] for r in iforest.tree_samples(rows, ["key"], 20_000).groupBy("tree").count().collect()}
    assert counts == {256}
    with pytest.raises(ValueError):
        trees.pack([(0, 0, -1, 0.0, 1.0)], 2, 8)


def test_samples_do_not_depend_on_partitioning(points):
    one = iforest.tree_samples(points, ["id"], 3010, n_trees=5).select("tree", "draw", "id")
    two = iforest.tree_samples(points.repartition(9), ["id"], 3010, n_trees=5).select("tree", "draw", "id")
    assert one.exceptAll(two).isEmpty() and one.count() == 5 * 256


def test_fit_does_not_depend_on_partitioning(points):
    one, two = (iforest.fit(p, ["a", "b"], ["id"], n_trees=5) for p in (points, points.repartition(7)))
    assert one.offset == two.offset and one.nodes.exceptAll(two.nodes).isEmpty()


def test_depth_is_limited_and_constant_data_is_one_leaf():
    nodes = trees.grow(np.random.default_rng(0).normal(size=(256, 3)), 42, 0, 8)
    assert max(slot for slot, *_ in nodes) < 511
    assert trees.grow(np.ones((10, 2)), 42, 0, 8) == [(0, trees.LEAF, np.inf, round(trees.average_path(10), 9))]


def test_draws_equal_the_hash_of_columns(evaluate):
    for parts in ((42, 7, 510, "cut"), (1, 0, 0, "feature")):
        assert evaluate(hash_unit(*[F.lit(p) for p in parts])) == trees.draw(*parts)


def test_sample_is_the_smallest_hashes(spark):
    """Against sorting all rows for every tree, with tasks that cut their sketches down several times."""
    rows = spark.range(50_000).select("id", (F.col("id") % 97).cast("double").alias("a")).repartition(3)
    order, ties = iforest.row_hash(["id", "a"], 42, dict(rows.dtypes))
    hashed = [tuple(r) for r in rows.select("id", order, ties).collect()]
    got = {}
    for r in iforest.tree_samples(rows, ["id", "a"], 50_000, n_trees=4, size=50).collect():
        got.setdefault(r["tree"], {})[r["draw"]] = r["id"]
    for tree, (factor, summand) in enumerate(zip(*iforest.tree_maps(4))):
        wanted = sorted(((h * int(factor) + int(summand)) % iforest.HASH_PRIME, tie, i) for i, h, tie in hashed)[:50]
        assert [got[tree][n] for n in range(1, 51)] == [i for *_, i in wanted]


def test_far_points_are_anomalies(points, forest):
    flagged = points.withColumn("d", forest.decision())
    share = flagged.agg(F.avg((F.col("d") < 0).cast("int"))).first()[0]
    assert 0.045 < share <= 0.051
    assert flagged.where("far and d >= 0").isEmpty()


def test_injected_outliers_score_lower(spark):
    tx = materialise(synthetic.outlier_transactions(synthetic.demo_users(spark, 20)), "outliers")
    model = training.fit_anomaly(tx)
    results, rejected = scoring.check_transactions(tx, model.averages, model.forest)
    means = dict(
        results.join(tx, "transaction_id").groupBy("is_injected").agg(F.avg("anomaly_score")).collect()
    )
    assert means[True] < means[False] and rejected.isEmpty()


def test_saved_model_scores_the_same(spark, tmp_path):
    tx = tx_orders(spark, "/root/testdata/sf0.001")
    model = training.anomaly_job(tx, str(tmp_path / "m"), str(tmp_path / "runs"))
    loaded = training.load_anomaly_model(spark, str(tmp_path / "m"))
    one, _ = scoring.check_transactions(tx, model.averages, model.forest)
    two, _ = scoring.check_transactions(tx, loaded.averages, loaded.forest)
    assert one.count() == 1500 and one.exceptAll(two).isEmpty()
    log = {r.key: r.value for r in spark.read.parquet(str(tmp_path / "runs")).collect()}
    assert float(log["n_anomalies"]) + float(log["n_normal"]) == 1500 and log["n_samples"] == "1500"
    assert float(log["anomaly_ratio_percent"]) == pytest.approx(5, abs=0.5)
    assert one.where("is_anomaly").count() == float(log["n_anomalies"])


def test_unseen_category_is_rejected(spark, tx):
    known = tx(*[(1, 1 + i % 2, 10 + i, "2025-01-01") for i in range(60)])
    model = training.fit_anomaly(known, n_trees=5)
    results, rejected = scoring.check_transactions(
        tx((1, 1, 5, "2025-01-02"), (1, 9, 5, "2025-01-02")), model.averages, model.forest
    )
    assert results.count() == 1
    assert [(r.category_id, r.error) for r in rejected.collect()] == [(9, scoring.UNSEEN_CATEGORY)]


def test_features_and_zero_average(tx):
    rows = tx((1, 1, 30, "2025-01-05"), (1, 1, 10, "2025-01-06"), (1, 2, 4, "2025-01-31"), (1, 2, -4, "2025-01-31"))
    features = anomaly_features(rows, materialise(category_average(rows), "averages"))
    got = [tuple(r) for r in features.orderBy("transaction_id").select(*ANOMALY_FEATURES).collect()]
    assert got == [(30.0, 1, 6, 5, 1.5), (10.0, 1, 0, 6, 0.5), (4.0, 2, 4, 31, 4.0), (-4.0, 2, 4, 31, -4.0)]


def test_too_little_data(spark, tx, tmp_path):
    with pytest.raises(ValueError):
        training.anomaly_job(tx((1, 1, 1, "2025-01-01")), str(tmp_path / "m"), str(tmp_path / "r"))


def test_injected_outliers_are_flagged_more_often(spark):
    found = {r["is_injected"]: r["n_flagged"] / r["n"] for r in QUERIES["iforest_detection"](spark, SMALL).collect()}
    assert found[True] > 3 * found[False]


def test_marks_of_injected_outliers_are_not_joined_back(spark):
    found = QUERIES["iforest_detection"](spark, SMALL)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_tabulated_paths_equal_a_walk_level_by_level():
    rng = np.random.default_rng(3)
    columns = [rng.normal(size=4000), rng.integers(0, 7, 4000).astype(float), np.exp(3 * rng.normal(size=4000)), np.full(4000, 2.0)]
    rows = np.array(columns).T
    nodes = [(t, *node) for t in range(30) for node in trees.grow(rows[rng.choice(4000, 256, replace=False)], 42, t, 8)]
    # One more tree is a single leaf.
    packed = trees.pack([*nodes, (30, *trees.grow(np.ones((9, 4)), 42, 30, 8)[0])], 31, 8)
    cuts, order, tables = trees.tabulate(*packed, 4)
    columns[0][:200] = cuts[0][:200]
    for i, value in enumerate((np.nan, np.inf, -np.inf)):
        for column in columns:
            column[300 + 50 * i : 340 + 50 * i] = value
    assert np.array_equal(trees.tabulated_mean_path(columns, cuts, order, tables), trees.mean_path(columns, *packed, 8))
    assert 1 <= len(trees._groups([np.searchsorted(c, v) for c, v in zip(cuts, columns)], cuts, order)[0]) < 4


def test_scores_of_many_and_of_no_rows(spark, points, forest, monkeypatch):
    monkeypatch.setattr(iforest, "SCORED_AT_ONCE", 700)
    score = forest.score(F.col("a"), F.col("b")).alias("score")
    scored = points.coalesce(1).select("id", "a", "b", score)
    one_by_one = trees.tabulated_mean_path([np.array(scored.toPandas()[c]) for c in "ab"], *forest.packed.value[0])
    wanted = -np.power(2.0, -one_by_one / trees.average_path(256))
    assert np.array_equal(np.array(scored.toPandas()["score"]), wanted)
    assert points.where("id < 0").select(score).count() == 0
    one = iforest.fit(points, ["a"], ["id"], n_trees=3)
    assert points.select(one.score(F.col("a")).alias("score")).where("score between -1 and 0").count() == 3010


@pytest.mark.parametrize("limit", ["MOST_ENTRIES", "MOST_ENTRIES_OF_ALL"])
def test_a_forest_too_large_for_tables_scores_the_same(points, forest, monkeypatch, limit):
    monkeypatch.setattr(trees, limit, 1000)
    walked = iforest.Forest(forest.nodes, forest.feature_cols, forest.trees, forest.sample_size)
    assert walked.packed.value[0] is None and forest.packed.value[0] is not None
    both = points.select(forest.score(F.col("a"), F.col("b")).alias("one"), walked.score(F.col("a"), F.col("b")).alias("two"))
    assert both.where("one <> two").isEmpty()


def test_few_wanted_hashes_are_looked_up(spark, monkeypatch):
    rows = spark.range(60_000).select("id", F.rand(3).alias("a"))
    wanted = {tuple(r) for r in iforest.tree_samples(rows, ["id", "a"], 60_000, n_trees=4, size=5).collect()}
    # As if there were so many rows that few hashes are wanted.
    monkeypatch.setattr(iforest, "MOST_WANTED", 10**9)
    hashed = iforest._few_hashed
    found = []
    monkeypatch.setattr(iforest, "_few_hashed", lambda *a: found.append(hashed(*a)) or found[-1])
    assert {tuple(r) for r in iforest.tree_samples(rows, ["id", "a"], 60_000, n_trees=4, size=5).collect()} == wanted
    assert found[0] is not None and len(wanted) == 20


def test_wanted_hashes_are_those_below_the_share(spark):
    factors, summands = iforest.tree_maps(3)
    limit = 40_000
    for r in iforest.wanted_hashes(spark, (limit + 0.5) / iforest.HASH_PRIME, 3).orderBy(F.rand(1)).limit(500).collect():
        order = int(r["wanted"], 16)
        assert len(r["wanted"]) == 7 and order < 1 << 28 and r["hash"] < limit
        assert (order * int(factors[r["tree"]]) + int(summands[r["tree"]])) % iforest.HASH_PRIME == r["hash"]
    n = iforest.wanted_hashes(spark, (limit + 0.5) / iforest.HASH_PRIME, 3).count()
    assert n == pytest.approx(3 * limit / 8, rel=0.05)
