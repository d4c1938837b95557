import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sightline.operators import learning, rules
from tests.conftest import values


@pytest.fixture(scope="module")
def basket_list():
    rng = random.Random(11)
    return [
        sorted({f"i{rng.randrange(6)}" for _ in range(4)} | {rng.choice(["yes", "no"])}) for _ in range(60)
    ]


def brute_force(baskets, support, confidence, rhs=None):
    n = len(baskets)
    counts = {}
    for basket in baskets:
        for k in range(1, len(basket) + 1):
            for items in combinations(basket, k):
                counts[items] = counts.get(items, 0) + 1
    found = {}
    for items, count in counts.items():
        if count < support * n or len(items) < 2:
            continue
        for target in items:
            left = tuple(i for i in items if i != target)
            c = count / counts[left]
            if c >= confidence and (rhs is None or target in rhs):
                found[left, target] = (count / n, c, c / (counts[(target,)] / n))
    return found


def test_rules_match_brute_force(spark, basket_list):
    frame = spark.createDataFrame([(b,) for b in basket_list], "items array<string>")
    mined = rules.mine(frame, rules.RuleSettings(0.05, 0.4, 2))
    got = {(tuple(r["antecedent"]), r["consequent"][0]): (r["support"], r["confidence"], r["lift"]) for r in mined.collect()}
    want = brute_force(basket_list, 0.05, 0.4)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    limited = rules.mine(frame, rules.RuleSettings(0.05, 0.4, 3, ("yes", "no")))
    kept = {(tuple(r["antecedent"]), r["consequent"][0]) for r in limited.collect()}
    assert kept == {k for k in brute_force(basket_list, 0.05, 0.4, ("yes", "no")) if len(k[0]) >= 2}
    top = rules.by_lift(mined, 4, 10).collect()
    lifts = sorted((v[2] for v in want.values()), reverse=True)
    assert [r["lift"] for r in top] == pytest.approx(lifts[3:10])
    assert rules.confident(mined, 0.8).count() == sum(v[1] > 0.8 for v in want.values())
    assert rules.with_item(mined, "yes").count() == sum("yes" in (*k[0], k[1]) for k in want)
    assert {r["rules"] for r in rules.summary(mined).collect()} == {len(want)}
    assert sum(r["n"] for r in rules.lengths(mined).collect()) == len(want)


def test_rules_from_the_empty_antecedent(spark, basket_list):
    rows = [(b,) for b in basket_list] + [([],), (None,), (["yes", "yes", None],)]
    frame = spark.createDataFrame(rows, "items array<string>")
    clean = [tuple(sorted({i for i in b or [] if i})) for (b,) in rows]
    for wide in (False, True):
        if wide:
            frame = spark.createDataFrame([(list(b),) for b in clean], "items array<string>")
        got = rules.mine(frame, rules.RuleSettings(0.05, 0.3, 1, wide=wide)).collect()
        single = {r["consequent"][0]: r for r in got if not r["antecedent"]}
        shares = {i: sum(i in b for b in clean) / len(clean) for i in {i for b in clean for i in b}}
        assert set(single) == {i for i, s in shares.items() if s >= 0.3}
        for i, r in single.items():
            assert (r["support"], r["confidence"], r["lift"]) == pytest.approx((shares[i], shares[i], 1.0))
        want = brute_force(clean, 0.05, 0.3)
        assert {(tuple(r["antecedent"]), r["consequent"][0]) for r in got if r["antecedent"]} == set(want)
    assert rules.mine(frame.limit(0), rules.SETTINGS["default"]).collect() == []


def test_low_support_takes_every_set(spark, basket_list):
    frame = spark.createDataFrame([(b,) for b in basket_list], "items array<string>")
    settings = rules.RuleSettings(0.0001, 0.7, 2, ("yes", "no"))
    got = {(tuple(r["antecedent"]), r["consequent"][0]) for r in rules.mine(frame, settings).collect()}
    assert got == set(brute_force(basket_list, 0.0001, 0.7, ("yes", "no")))
    pairs = rules.frequent_itemsets(frame, 0.05, max_length=2)
    assert {r["n"] for r in pairs.collect()} and all(len(r["items"]) <= 2 for r in pairs.collect())


def test_wide_baskets_are_counted_in_blocks(spark, basket_list, monkeypatch):
    monkeypatch.setattr(rules, "BLOCK_BASKETS", 64)
    monkeypatch.setattr(rules, "STEMS_AT_ONCE", 3)
    rows = [(b,) for b in basket_list * 5] + [([],), (None,), (["yes", "yes", None, "rare"],)]
    frame = spark.createDataFrame(rows, "items array<string>").repartition(3)
    for most in (1, 2, 3, 10):
        want = {tuple(r["items"]): r["n"] for r in rules.frequent_itemsets(frame, 0.03, most).collect()}
        got = rules.grown_itemsets(frame, 0.03, most).collect()
        assert {tuple(r["items"]): r["n"] for r in got} == want and len(got) == len(want)
    assert rules.grown_itemsets(frame.limit(0), 0.1).collect() == []


def test_one_item_rules_match_brute_force(spark, basket_list):
    frame = spark.createDataFrame([(b,) for b in basket_list], "items array<string>")
    got = {
        ((r["antecedent"],), r["consequent"]): (r["support"], r["confidence"], r["lift"])
        for r in rules.one_item_rules(frame, ("yes", "no")).collect()
    }
    want = {k: v for k, v in brute_force(basket_list, 0, 0, ("yes", "no")).items() if len(k[0]) == 1}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.fixture(scope="module")
def features(spark):
    """Two hundred separable rows: customer a sees the high ones, b the low ones."""
    rows = [
        (f"1.1.1.{i}", 9.0, 1.0, 5.0, 8.0 if i % 2 else 2.0, 0.0, 0.0, float(i % 7), 3, "a", 2,
         3 if i % 2 else 0, 0 if i % 2 else 4)
        for i in range(200)
    ]
    names = "ip string, maxScore double, minScore double, avgScore double, lastScore double, trendUp double, trendDown double, trueCount double, dataSetCount long, mostCommonCustomerHit string, totalCustomersHit long, a long, b long"
    return spark.createDataFrame(rows, names)


def test_vectors_have_a_stated_order(features):
    vectors = learning.profile_vectors(features)
    assert learning.feature_names(vectors) == ["a", "b", "dataSetCount", "totalCustomersHit", "trendDown", "trendUp", "trueCount"]
    assert learning.feature_names(learning.svm_vectors(features)) == ["a", "b", "totalCustomersHit"]


def test_neutral_rows_leave_before_training(features):
    neutral = features.withColumn("lastScore", F.when(F.col("a") == 0, 5.0).otherwise(8.0))
    assert learning.profile_vectors(neutral, without_neutral=True).count() == 100
    assert learning.profile_vectors(neutral).count() == 200


# A forest of three shallow trees may never draw a telling column at its roots,
# so only the large forest can be held to the bound.
@pytest.mark.parametrize("name", ["ml_tree2", "ml_rf3", "ml_lr3", "ml_gbt2"])
def test_learners_separate_the_separable(features, name):
    learner = learning.LEARNERS[name]
    vectors = learning.profile_vectors(features, without_neutral=learner.vectors == "no_neutral")
    report = dict(values(learning.train_and_report(vectors, learner, folds=2)))
    assert report["held_out"] > 0.95 and report["training"] > 0.95 and report["rows"] == 200
    weights = {k: v for k, v in report.items() if k.startswith("importance:")}
    if weights:
        assert sum(weights.values()) == pytest.approx(1.0)


def test_small_forest_reports_what_the_large_one_does(features):
    learner = learning.LEARNERS["ml_rf2"]
    report = dict(values(learning.train_and_report(learning.profile_vectors(features), learner, folds=2)))
    assert report["rows"] == 200 and report["held_out"] >= 0.5


def test_svm_saves_loads_and_scores(features, tmp_path):
    vectors = learning.svm_vectors(features)
    model, report = learning.train_svm(vectors)
    row = report.first()
    assert row["error_rate"] < 0.05 and row["true_positive"] > 20 and row["true_negative"] > 20
    learning.save_model(model, str(tmp_path / "svm"))
    again = learning.load_svm(str(tmp_path / "svm"))
    scored = [values(m.transform(vectors), "ip", "prediction") for m in (model, again)]
    assert scored[0] == scored[1]
    counts = learning.score_cohort(again, learning.svm_scoring_vectors(features)).first()
    assert counts["above"] + counts["below"] == 200 and abs(counts["above"] - 100) < 10
    _, balanced = learning.train_svm(vectors, balanced=True)
    assert balanced.first()["error_rate"] < 0.05


def test_folds_are_fixed_by_the_rows(features):
    vectors = learning.profile_vectors(features)
    first = values(learning.with_folds(vectors, 10), "ip", "fold")
    assert first == values(learning.with_folds(vectors.repartition(7), 10), "ip", "fold")
    assert {f for _, f in first} <= set(range(10))


def test_cross_validation_agrees_with_the_one_of_spark(features):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    noisy = features.withColumn("lastScore", F.when(F.pmod(F.xxhash64("ip"), F.lit(5)) == 0, 2.0).otherwise(F.col("lastScore")))
    vectors = learning.with_folds(learning.profile_vectors(noisy), 4)
    tree = DecisionTreeClassifier(maxDepth=2)
    search = CrossValidator(
        estimator=tree, estimatorParamMaps=ParamGridBuilder().addGrid(tree.maxDepth, [2, 5]).build(),
        evaluator=learning.evaluator("multiclass"), numFolds=4, foldCol="fold",
    ).fit(vectors)
    found = learning.cross_validate(vectors, learning.LEARNERS["ml_tree2"], folds=4)
    assert found.avgMetrics == pytest.approx(search.avgMetrics) and 0.5 < min(found.avgMetrics) < 1
    assert found.bestModel.toDebugString.split("\n")[1:] == search.bestModel.toDebugString.split("\n")[1:]
    with pytest.raises(ValueError, match="fold 0 has no rows"):
        learning.cross_validate(vectors.where("fold = 0"), learning.LEARNERS["ml_tree2"], folds=4)


def test_vectors_are_cached_in_few_parts_and_no_copies(features, monkeypatch):
    spread = learning.with_folds(learning.profile_vectors(features), 3).repartition(64)
    laid = learning.laid_out(spread)
    assert laid.rdd.getNumPartitions() == 1 and laid.columns == ["fold", "label", "features"]
    assert learning.feature_names(laid) == learning.feature_names(spread)
    monkeypatch.setattr(learning, "LARGE_PART", 60)
    assert learning.laid_out(spread).rdd.getNumPartitions() == 4
    monkeypatch.setattr(learning, "ROWS_AT_ONCE", 1)
    assert learning.cross_validate(laid, learning.LEARNERS["ml_tree2"], folds=3).avgMetrics[0] > 0.95


def test_indexing_works_the_rows_out_once(spark):
    rows = [("h", "Asia", "x", 1.0, f"d{i % 2}", i, "IT", "small", "e") for i in range(9)]
    frame = spark.createDataFrame(rows, learning.DISTINCT_COLUMNS)
    indexed = learning.index_categories(frame)
    assert indexed.count() == 9 and {r["rescoreIndex"] for r in indexed.collect()} == {0.0, 1.0}
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "Exchange" not in plan


def test_logistic_formula(spark):
    rng = random.Random(2)
    rows = [(float(rng.random() < (0.8 if x > 5 else 0.2)), x) for x in (rng.random() * 10 for _ in range(300))]
    frame = spark.createDataFrame(rows, "y double, x double")
    _, metrics = learning.fit_logistic_formula(frame, "y ~ x", folds=3)
    report = dict(values(metrics))
    assert 0 < report["aic"] < 420 and 0 < report["cv_cost"] < 0.25 and 0 < report["r2"] < 1


@pytest.mark.parametrize("name", ["ml_tree", "ml_rf"])
def test_trees_learn_the_same_from_counted_rows(spark, name):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        size, seen, high = rng.randrange(3), float(rng.randrange(20)), rng.random() < 0.1
        label = "up" if (seen > 11) != high else "down"
        rows.append((f"h{i}", "EU", "x", seen, label, rng.randrange(9), f"s{size}", "small", "low"))
    names = "data string, continent string, country string, count_seen double, score_direction string, elapsed long, sector string, size string, estimate string"
    indexed = learning.index_categories(spark.createDataFrame(rows, names)).localCheckpoint()
    learner = learning.LEARNERS[name]
    plain = learning.counted_vectors(indexed, learner, 3, least=3001)
    counted = learning.counted_vectors(indexed, learner, 3, least=3000)
    assert "counts" not in plain.columns and counted.count() < 2000
    assert sum(sum(r["counts"]) for r in counted.select("counts").collect()) == 3000
    want, got = (
        {r["name"]: r["value"] for r in learning.train_and_report(v, learner, folds=3).collect()} for v in (plain, counted)
    )
    assert got.keys() == want.keys() and got["rows"] == want["rows"] == 3000
    if name == "ml_tree":
        assert got == pytest.approx(want)
        return
    assert abs(got["held_out"] - want["held_out"]) < 0.1
    # Draws are of mean one and of variance one row by row, not vector by vector.
    n = [sum(r["counts"]) for r in counted.select("counts").collect()]
    for k in range(3):
        drawn = [sum(r[0]) for r in counted.select(f"draw_{k}").collect()]
        spread = sum((d - c) ** 2 for d, c in zip(drawn, n)) / 3000
        assert abs(sum(drawn) - 3000) < 200 and 0.8 < spread < 1.2


def test_counted_rows_put_numbers_in_bins(spark):
    rows = [(f"h{i}", "EU", "x", float(i), "up" if i % 3 else "down", i % 2, "s", "small", "low") for i in range(2000)]
    names = "data string, continent string, country string, count_seen double, score_direction string, elapsed long, sector string, size string, estimate string"
    indexed = learning.index_categories(spark.createDataFrame(rows, names))
    counted = learning.counted_vectors(indexed, learning.LEARNERS["ml_tree"], 2, least=1).collect()
    bins = sorted({float(r["features"][5]) for r in counted})
    assert bins == [float(i) for i in range(learning.BINS)] and {r["features"][4] for r in counted} == {0.0, 1.0}
    assert sum(sum(r["counts"]) for r in counted) == 2000


def test_rules_last_score_mines_at_the_lowest_support(spark, tmp_path):
    from datetime import datetime

    from sightline.plans import registry

    rng = random.Random(12)
    day = datetime(1996, 3, 1)
    lines = [
        (i, 1, i, rng.randrange(12), 1.0, rng.randrange(10) / 100, day)
        for i in range(250)
    ] + [(250 + i, 2, i, 20 + i % 40, 2.0, 0.09, day) for i in range(0, 250, 5)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_shipdate timestamp"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(i, day, "5-LOW") for i in range(500)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp, o_orderpriority string").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    baskets = [tuple(r["items"].split(",")) for r in registry.QUERIES["baskets"](spark, str(tmp_path)).collect()]
    want = brute_force(baskets, 0.0001, 0.7, rules.SETTINGS["last_score"].consequents)
    found = registry.QUERIES["rules_last_score"](spark, str(tmp_path)).collect()
    got = {(tuple(r["antecedent"].split("|")), r["consequent"]): r["support"] for r in found}
    assert got == pytest.approx({k: v[0] for k, v in want.items()}, abs=1e-6)
    assert min(got.values()) < 0.01
