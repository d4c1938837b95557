import random

import pytest
from pyspark.sql import functions as F

from sightline.functions.values import with_score_order
from sightline.operators import cohorts, labels, learning, profile, sampling, series, stats
from tests.conftest import sightings, values


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def random_sightings(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        first = rng.randrange(50)
        # One IP holds a third of all rows.
        data = "9.9.9.9" if rng.random() < 0.33 else f"1.1.1.{rng.randrange(30)}"
        rows.append(
            {
                "record_id": f"r{i}",
                "anonymous_id": f"c{rng.randrange(6)}",
                "data": data,
                "count_seen": float(rng.randrange(1, 400)),
                "first_seen": first,
                "last_seen": first + rng.randrange(20),
                "threat_score": float(rng.randrange(10)),
            }
        )
    return rows, sightings(spark, *rows)


def test_profile_of_shuffled_sightings(spark):
    """Highest score is a maximum, the mean is a true mean, first and last go by time."""
    rows = sightings(
        spark,
        {"first_seen": 20, "last_seen": 30, "threat_score": 9.0, "count_seen": 7.0},
        {"first_seen": 10, "last_seen": 40, "threat_score": 2.0, "count_seen": 3.0},
        {"first_seen": 15, "last_seen": 50, "threat_score": 6.0, "count_seen": 5.0},
    )
    got = profile.ip_profile(rows).first().asDict()
    assert got == {
        "ip": "1.2.3.4",
        "maxScore": 9.0,
        "minScore": 2.0,
        "avgScore": pytest.approx(17 / 3),
        "lastScore": 6.0,
        "trendUp": 1.0,
        "trendDown": 0.0,
        "trueCount": 7.0,
        "dataSetCount": 3,
        "mostCommonCustomerHit": "c1",
        "totalCustomersHit": 1,
    }


def test_profile_matches_a_plain_loop(spark):
    rows, frame = random_sightings(spark)
    expected = {}
    for ip in {r["data"] for r in rows}:
        own = [r for r in rows if r["data"] == ip]
        scores = [r["threat_score"] for r in own]
        first = min((r["first_seen"], r["threat_score"]) for r in own)[1]
        last = max((r["last_seen"], r["threat_score"]) for r in own)[1]
        counts = {}
        for r in own:
            counts[r["anonymous_id"]] = counts.get(r["anonymous_id"], 0) + 1
        moved = max(scores) != min(scores)
        expected[ip] = (
            max(scores), min(scores), sum(scores) / len(scores), last,
            float(moved and first < last), float(moved and first > last),
            max(r["count_seen"] for r in own), len(own),
            min(counts, key=lambda c: (-counts[c], c)), len(counts), counts,
        )
    wide = profile.ip_features_wide(frame)
    customers = wide.columns[11:]
    assert customers == sorted(customers)
    for row in wide.collect():
        want = expected[row["ip"]]
        assert tuple(row)[1:11] == pytest.approx(want[:10])
        assert {c: row[c] for c in customers if row[c]} == want[10]
        assert sum(row[c] for c in customers) == row["dataSetCount"]
        assert row["trendUp"] * row["trendDown"] == 0


def test_ties_go_to_the_smallest_customer(spark):
    rows = sightings(spark, {"anonymous_id": "b"}, {"anonymous_id": "a"})
    assert profile.most_common_customer(rows).first()["mostCommonCustomerHit"] == "a"
    assert profile.ip_profile(rows).first()["mostCommonCustomerHit"] == "a"


def test_variants(spark):
    rows = sightings(
        spark,
        {"anonymous_id": "a", "threat_score": 6.0},
        {"anonymous_id": "b", "threat_score": 7.0, "first_seen": 3, "last_seen": 4},
    )
    flag = profile.ip_features_flag(rows)
    assert flag.columns[:2] == ["ip", "avgScore > 5"] and flag.first()[1] == 1.0
    full = profile.ip_profile_full(rows, ["a", "c"]).first()
    assert full["totalCustomersHit"] == 1 and full["a"] == 1 and full["c"] == 0
    assert full["trendUp"] == 1.0
    assert [r[0] for r in profile.customer_list(rows).collect()] == ["a", "b"]
    assert profile.single_ip(rows, "1.2.3.4").count() == 2
    with pytest.raises(ValueError):
        profile.customer_ids(rows, limit=1)


def test_null_scores_and_times_do_not_count_as_extremes(spark):
    rows = sightings(
        spark,
        {"threat_score": None, "first_seen": 0, "last_seen": 99},
        {"threat_score": 3.0, "first_seen": None, "last_seen": 5},
        {"threat_score": 4.0, "first_seen": 2, "last_seen": 4},
    )
    got = profile.first_last_scores(rows).first()
    assert (got["firstScore"], got["lastScore"]) == (4.0, 3.0)


def test_profile_stays_in_the_jvm_and_never_sorts(spark):
    _, frame = random_sightings(spark, 20)
    text = plan(profile.ip_profile(frame))
    assert "EvalPython" not in text and "MapInPandas" not in text
    # Rows are hashed, not sorted, and the only joins are with the small table of customers.
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHash" not in text
    assert "SortMergeJoin" not in text and "NestedLoop" not in text
    assert "Join" not in plan(profile.trends(frame)) and "SortAggregate" not in plan(profile.trends(frame))


def test_extremes_by_time_with_ties_and_odd_scores(spark):
    odd = [0.0, 5e-324, 2.2250738585072014e-308, 0.1, 0.30000000000000004, 1.0, 4.0, 4.000000000000001, 1.7e308,
           float("inf"), float("nan")]
    odd = [-x for x in odd[1:-1]] + odd
    frame = spark.createDataFrame([(x,) for x in odd] + [(None,)], "x double")
    got = {repr(r["x"]): r["o"] for r in with_score_order(frame, "x", "o").collect()}
    assert got.pop("None") is None
    want = sorted(odd, key=lambda x: (x != x, x))
    assert sorted(got, key=got.get) == [repr(x) for x in want] and len(set(got.values())) == len(odd)
    rng = random.Random(9)
    drawn = [(str(rng.randrange(8)), str(rng.randrange(3)), rng.choice([-7, 0, 3, 1700000000000000000]), rng.choice(odd[:-1]))
             for _ in range(600)]
    rows = sightings(spark, *[
        {"data": ip, "anonymous_id": c, "first_seen": t, "last_seen": t, "threat_score": x} for ip, c, t, x in drawn
    ])
    for ip, first, last in values(profile.first_last_scores(rows)):
        mine = [(t, x) for i, _, t, x in drawn if i == ip]
        assert (first, last) == (min(mine)[1], max(mine)[1])
    with pytest.raises(Exception, match="5e18"):
        profile.ip_profile(sightings(spark, {"first_seen": 6 * 10**18})).collect()


def test_customers_are_numbered_in_order_without_gaps(spark):
    ids = [f"c{i * 7919 % 3000}" for i in range(3000)]
    rows = sightings(spark, *[{"anonymous_id": c} for c in [*ids, None, ids[0]]]).repartition(5)
    got = profile.customer_index(rows).orderBy("customer").collect()
    assert [tuple(r) for r in got] == [(c, i) for i, c in enumerate(sorted(ids))]
    assert profile.customer_index(sightings(spark, {"anonymous_id": None})).count() == 0


def test_sparse_counts_hold_what_the_wide_columns_hold(spark):
    _, frame = random_sightings(spark)
    names = profile.customer_ids(frame)
    wide = {r["ip"]: r.asDict() for r in profile.ip_features_wide(frame).collect()}
    sparse = profile.ip_features_sparse(frame).collect()
    assert len(sparse) == len(wide)
    for row in sparse:
        want = wide[row["ip"]]
        assert row["customerCounts"].toArray().tolist() == [want[c] for c in names]
        assert all(row[c] == want[c] or row[c] is want[c] for c in profile.PROFILE_COLUMNS)
    vectors = learning.profile_vectors(profile.ip_features_sparse(frame))
    by_name = learning.profile_vectors(profile.ip_features_wide(frame))
    assert learning.feature_names(vectors) == learning.feature_names(by_name)
    # Places without a customer in the part: the index of a larger table.
    part = frame.where(F.col("anonymous_id") == names[-1])
    one = profile.ip_features_sparse(part, profile.customer_index(frame)).first()["customerCounts"]
    assert one.size == len(names) and one.indices.tolist() == [len(names) - 1]


def test_a_hundred_thousand_customers_profile_and_train(spark):
    base = sightings(spark, {}).drop("anonymous_id", "data", "threat_score")
    many = spark.range(200_000).select(
        F.format_string("c%06d", F.col("id") % 100_000).alias("anonymous_id"),
        F.concat(F.lit("ip"), F.col("id") % 400).alias("data"),
        (F.col("id") % 400 % 2 * 8).cast("double").alias("threat_score"),
    )
    rows = many.crossJoin(F.broadcast(base)).select(*sightings(spark).columns)
    features = profile.ip_features_sparse(rows).persist()
    assert features.count() == 400
    vector = features.first()["customerCounts"]
    assert vector.size == 100_000 and vector.toArray().sum() == 500
    vectors = learning.profile_vectors(features)
    model = learning.LogisticRegression(maxIter=3).fit(vectors)
    assert model.numFeatures == 100_000 + 5
    with pytest.raises(ValueError, match="ip_features_sparse"):
        profile.ip_features_wide(rows)
    features.unpersist()


def test_cohorts(spark):
    rows = sightings(spark, *[{"threat_score": float(s)} for s in range(10)])
    assert [r[0] for r in values(cohorts.targeted(rows), "threat_score")] == [1, 2, 3, 4, 6, 7, 8]
    assert dict(values(cohorts.cohort_counts(rows))) == {
        "all": 10, "targeted": 7, "no5s": 9, "only5s": 1, "no1s9s5s": 7,
    }


def test_cooccurrence_long_and_wide_agree(spark):
    _, frame = random_sightings(spark)
    wide = profile.ip_features_wide(frame)
    for customers in (["c0"], ["c0", "c1", "c2"], ["c0", "missing"]):
        long = cohorts.cooccurrence(frame, customers).first()[0]
        if "missing" in customers:
            assert long == 0
        else:
            assert long == cohorts.seen_by_all_wide(wide, customers).count()


def test_time_slice_is_inclusive(spark):
    rows = spark.createDataFrame([(0,), (31535999,), (31536000,), (-1,)], "first_seen long")
    assert cohorts.time_slice(rows, 1970, 1970).count() == 2
    assert cohorts.time_slice(rows, 1969, 1971).count() == 4


def test_samples_nest(spark):
    frame = spark.range(20000).repartition(4).persist()
    samples = sampling.bernoulli_samples(frame)
    drawn = [samples[f] for f in sampling.FRACTIONS]
    for small, large in zip(drawn, drawn[1:]):
        assert small.exceptAll(large).count() == 0
    small = sampling.hash_sample(frame, ["id"], 0.1)
    large = sampling.hash_sample(frame.repartition(9), ["id"], 0.25)
    assert small.exceptAll(large).count() == 0 and abs(small.count() / 20000 - 0.1) < 0.01
    train, test = sampling.hash_split(frame, ["id"])
    assert train.count() + test.count() == 20000 and abs(train.count() / 20000 - 0.65) < 0.02
    first, second = sampling.random_split(frame)
    assert first.count() + second.count() == 20000


def test_balance_evens_either_majority(spark):
    for zeros, ones in ((8000, 2000), (2000, 8000)):
        frame = spark.range(10000).select("id", (F.col("id") >= zeros).cast("double").alias("label"))
        for balanced in (sampling.balance(frame), sampling.hash_balance(frame, ["id"])):
            counts = dict(values(balanced.groupBy("label").count()))
            assert abs(counts[0.0] - counts[1.0]) < 300 and min(zeros, ones) == min(
                2000, max(counts.values()) + 2000
            )


def test_stat_tables_list_null_keys_with_no_rows(spark):
    rows = sightings(spark, {"sector": None}, {"sector": "IT"}, {"sector": "IT"})
    assert values(stats.sector_stats(rows)) == sorted([(None, 0), ("IT", 2)], key=repr)


def test_total_events_takes_bad_counts_as_zero(spark):
    rows = spark.createDataFrame([("3",), ("abc",), (None,), ("",)], "count_seen string")
    assert stats.total_events(rows).first()[0] == 3.0


def test_sector_rollup(spark):
    sectors = spark.createDataFrame(
        [("IT", 500), ("IT Sector", 400), ("govt services", 300), ("retail", 10), ("home", 9)],
        "sector string, count long",
    )
    assert dict(values(stats.sector_rollup(sectors, 10))) == {
        "Information Technology & Services": 900, "Government": 300, "Other": 19,
    }


def test_country_pivot_ranks_missing_labels_last(spark):
    counts = spark.createDataFrame(
        [("a", "High", 5), ("a", "Low", 1), ("b", "Low", 9), ("c", "High", 5), ("c", "Neutral", 2)],
        "country string, score_label string, count long",
    )
    assert [r["country"] for r in stats.top_countries(counts, 3).collect()] == ["c", "a", "b"]


def test_confusion(spark):
    scored = spark.createDataFrame(
        [(1.0, 1.0)] * 4 + [(0.0, 0.0)] * 3 + [(1.0, 0.0)] * 2 + [(0.0, 1.0)], "label double, prediction double"
    )
    assert tuple(stats.confusion(scored).first()) == (4, 3, 2, 1, 0.3)
    assert tuple(stats.prediction_counts(scored).first()) == (5, 5)


def test_label_counts_are_one(spark):
    _, frame = random_sightings(spark)
    counted = labels.label_counts(labels.score_directions(frame))
    assert {r["count"] for r in counted.collect()} == {1}
    sets = {r["data"]: r["scores"] for r in labels.score_sets(frame).collect()}
    assert all(s == sorted(set(s)) for s in sets.values())


@pytest.mark.parametrize("alpha, n", [(0.2, 3000), (0.9, 400), (0.01, 900)])
def test_ewm_matches_pandas_across_blocks(spark, alpha, n):
    import pandas as pd

    rng = random.Random(3)
    data = [(t * 3600, float(rng.randrange(100))) for t in range(n)]
    frame = spark.createDataFrame(data, "ts long, n double").repartition(5)
    got = [r[2] for r in sorted(series.ewm(frame, "ts", "n", alpha, 86400 * 7).collect())]
    want = pd.Series([v for _, v in data]).ewm(alpha=alpha).mean()
    assert got == pytest.approx(list(want), abs=1e-9)


def test_quantile_point_scans_in_time_order(spark):
    rng = random.Random(4)
    data = [(t * 1000, rng.randrange(100)) for t in range(500)]
    shuffled = data[:]
    rng.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "ts long, n long")
    total, run = sum(v for _, v in data), 0
    for ts, n in data:
        run += n
        if run >= total * 0.75:
            break
    got = series.quantile_point(frame, "ts", "n", 0.75, 40_000).collect()
    assert [tuple(r) for r in got] == [(ts, n, run)]


def test_describe_matches_pandas(spark):
    import pandas as pd

    data = [float(x * x % 37) for x in range(101)]
    frame = spark.createDataFrame([(x,) for x in data] + [(None,)], "n double")
    got = series.describe(frame, "n").first()
    want = pd.Series(data).describe()
    names = {"25%": "p25", "50%": "p50", "75%": "p75"}
    for key in want.index:
        assert got[names.get(key, key)] == pytest.approx(want[key])
