"""Fit, score, evaluate and the report tables."""

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

import samplefeed
from perigee import operators as op
from perigee.schema import FEATURE_COLUMNS, FLAT_SCHEMA, LABEL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean(spark):
    rows = op.split_keyed(op.clean_rows(op.with_day(op.flatten(samplefeed.messages(spark, SMALL))))).cache()
    yield rows
    rows.unpersist()


@pytest.fixture(scope="module")
def train(clean):
    return clean.where("is_train")


@pytest.fixture(scope="module")
def model(train):
    return op.fit(train)


def probabilities(df):
    return {
        tuple(row[c] for c in FEATURE_COLUMNS): (row["probability"][1], row["prediction"]) for row in df.collect()
    }


def test_column_scorer_equals_the_model(clean, model):
    ours = op.score_linear(clean, *op.as_linear(model))
    theirs = op.plain_vectors(op.score(clean, model)).select(*ours.columns)
    assert ours.dtypes == theirs.dtypes
    mine, other = probabilities(ours), probabilities(theirs)
    assert mine.keys() == other.keys()
    for key, (p, prediction) in mine.items():
        assert math.isclose(p, other[key][0], abs_tol=1e-9) and prediction == other[key][1]


def test_fit_is_at_a_minimum_and_learns(train, clean, model):
    scored = op.score_linear(train, *op.as_linear(model))
    residual = F.col("probability")[1] - F.col(LABEL)
    scaled = [F.col(c) / train.agg(F.stddev(c)).first()[0] for c in FEATURE_COLUMNS]
    gradient = scored.agg(F.avg(residual), *(F.avg(residual * x) for x in scaled)).first()
    assert max(abs(g) for g in gradient) < 1e-3
    test = op.score_linear(clean.where("NOT is_train"), *op.as_linear(model))
    assert op.accuracy(test).first()["accuracy"] > 0.9


def test_refit_on_parts_equals_fit_on_all(train, model):
    old, new = train.where("approach_date < '1998-01-01'"), train.where("approach_date >= '1998-01-01'")
    again = op.refit(old, new)
    together, apart = (probabilities(op.score_linear(train, *op.as_linear(m))) for m in (model, again))
    assert all(math.isclose(p, apart[key][0], abs_tol=1e-6) for key, (p, _) in together.items())
    assert op.refit(None, train).numClasses == 2


def test_accumulate_keeps_duplicates(train):
    assert op.accumulate(train, train).count() == 2 * train.count()


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_one_class_batch(train, label):
    one = train.withColumn(LABEL, F.lit(label))
    fitted = op.fit(one)
    for scored in (op.score(one, fitted), op.score_linear(one, *op.as_linear(fitted))):
        assert [row["prediction"] for row in scored.select("prediction").distinct().collect()] == [label]


def test_accuracy_equals_the_evaluator(clean, model):
    scored = op.score(clean.where("NOT is_train"), model)
    theirs = MulticlassClassificationEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName="accuracy"
    ).evaluate(scored)
    assert math.isclose(op.accuracy(scored).first()["accuracy"], theirs, rel_tol=1e-12)
    assert op.accuracy(scored.where("false")).first()["accuracy"] is None


def test_missing_features(spark, clean, model):
    rows = [("n", "2024-01-05", None, 1.0, 3.0, 4.0, 1.0)]
    row = spark.createDataFrame(rows, FLAT_SCHEMA)
    assert op.assemble(row).isEmpty()
    scored = op.score_linear(row, *op.as_linear(model)).first()
    assert scored["prediction"] is None and scored["probability"] is None
    table = op.score_table(row, model).first()
    assert table["prediction"] is None and table["predicted_value"] is None


def test_score_table(clean, model):
    inputs = clean.select(*FEATURE_COLUMNS)
    table = op.score_table(inputs, model)
    assert table.columns == [*FEATURE_COLUMNS, "prediction", "predicted_value"]
    texts = {(r[0], r[1]) for r in table.select("prediction", "predicted_value").distinct().collect()}
    assert texts == {(0.0, "Not Hazardous"), (1.0, "Hazardous")}
    with pytest.raises(ValueError, match="no model"):
        op.score_table(inputs, None)


def test_random_split_is_a_partition_and_repeats(clean):
    train, test = op.split_random(clean.select("name", "approach_date", "miss_distance_km"), seed=7)
    total = clean.count()
    assert train.count() + test.count() == total
    assert abs(train.count() / total - 0.8) < 0.05
    again, _ = op.split_random(clean.select("name", "approach_date", "miss_distance_km"), seed=7)
    assert again.exceptAll(train).isEmpty() and train.exceptAll(again).isEmpty()


def test_keyed_split_share(clean):
    share = clean.agg(F.avg(F.col("is_train").cast("double"))).first()[0]
    assert abs(share - 0.8) < 0.03


def test_reports(spark, clean):
    scored = op.score_linear(clean, (0.0, 1.0, 0.0, 0.0), -3.0)
    display = op.display_rows(scored)
    assert display.columns == [
        "name",
        "close_approach_date",
        "estimated_diameter_km_max",
        "estimated_diameter_km_min",
        "relative_velocity_km_s",
        "miss_distance_km",
        "real_value",
        "predicted_value",
    ]
    assert op.report_rows(scored).columns == [
        "name", "real_value", "predicted_value", "estimated_diameter_km_min", "miss_distance_km"
    ]
    total = clean.count()
    grid = op.scatter_grid(display, 10000, 0.25)
    assert grid.agg(F.sum("count")).first()[0] == total
    assert op.confusion_counts(display).agg(F.sum("count")).first()[0] == total
    assert op.scatter_points(display, "predicted_value").where("class = 'Hazardous'").count() == scored.where(
        "prediction = 1"
    ).count()


def test_export_of_model_scores(tmp_path, spark, clean, model):
    scored = op.score(clean.where("NOT is_train"), model).withColumn("batch_id", F.lit(3))
    op.export_scored(scored, f"{tmp_path}/export")
    back = spark.read.parquet(f"{tmp_path}/export")
    assert dict(back.dtypes)["features"] == "array<double>"
    assert back.where("batch_id = 3").count() == scored.count()


def labelled(spark, rows):
    schema = ", ".join(f"{c} DOUBLE" for c in (*FEATURE_COLUMNS, LABEL))
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], schema)


def test_newton_finds_the_default_fit_in_few_passes(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4)) * [1, 5, 1000, 1e7] + [3, 0, 500, 4e7]
    margin = (x - x.mean(0)) / x.std(0) @ [1.5, -1, 0.2, 0.5] - 0.7
    y = rng.random(600) < 1 / (1 + np.exp(-margin))
    rows = labelled(spark, np.column_stack([x, y]))
    newton, default = op.Newton(), op.as_linear(op.fit(rows))
    found = newton(rows)
    cold = newton.passes
    assert np.allclose([*found.coefficients, found.intercept], [*default.coefficients, default.intercept], rtol=1e-4)
    assert cold <= 10
    more = labelled(spark, np.column_stack([x, y])[:30])
    again = newton(op.accumulate(rows, more), found)
    assert newton.passes < cold and again != found
    assert newton(rows, found).coefficients == pytest.approx(found.coefficients) and newton.passes == 2


def test_newton_ends_on_hard_input(spark):
    newton = op.Newton()
    apart = labelled(spark, [(k, 1, k * k, 0, k > 5) for k in range(12)])
    model = newton(apart)
    assert newton.passes <= newton.most and model.coefficients[1] == model.coefficients[3] == 0.0
    scored = op.score_linear(apart, *model)
    assert op.accuracy(scored).first()["accuracy"] == 1.0
    assert newton(labelled(spark, [(1, 2, 3, 4, 1)] * 3)).intercept == float("inf")
    assert newton(labelled(spark, [(1, 2, 3, 4, 0), (2, 2, 3, 4, 0)])).intercept == float("-inf")
    assert newton(labelled(spark, [(1, 2, 3, 4, 0), (2, 2, 3, 4, 1)]), op.LinearModel((0.0,) * 4, float("inf"))).intercept < 0
    with pytest.raises(ValueError):
        newton(labelled(spark, []))


def test_a_far_point_leaves_the_grid_bounded(spark):
    rows = [(float(k), float(k % 7), "A") for k in range(100)] + [(1e300, -1e300, "B"), (float("nan"), 1.0, "A"), (None, 1.0, "A")]
    display = spark.createDataFrame(rows, "miss_distance_km double, estimated_diameter_km_min double, real_value string")
    for within in (None, (0.05, 0.95)):
        cells = op.bounded_grid(display, 8, 4, within=within).collect()
        assert {(c["x_bin"] in range(8), c["y_bin"] in range(4)) for c in cells} == {(True, True)}
        assert sum(c["count"] for c in cells) == 101 and len(cells) <= 2 * 8 * 4
    assert len(cells) > 8  # quantiles keep the crowd apart in spite of the far point
    assert op.bounded_grid(display.limit(0), 8, 4).collect() == []
    one = op.bounded_grid(display.where("miss_distance_km = 3"), 8, 4).collect()
    assert [tuple(c) for c in one] == [(0, 0, "A", 1)]


def test_export_of_new_batches_alone(spark, tmp_path):
    def scored(*batches):
        return spark.createDataFrame([(f"n{b}-{k}", b) for b in batches for k in range(3)], "name string, batch_id bigint")

    target = str(tmp_path / "export")
    assert op.export_new(scored(0, 1), target) == [0, 1]
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "export").rglob("*.parquet")}
    assert op.export_new(scored(0, 1, 2), target) == [2]
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())
    assert op.export_new(scored(0, 1, 2), target) == []
    # As after a run that failed before it listed what it wrote.
    spark.createDataFrame([("half", 3)], "name string, batch_id bigint").write.mode("append").partitionBy("batch_id").parquet(target)
    assert op.export_new(scored(0, 1, 2, 3), target) == [3]
    back = spark.read.parquet(target)
    assert sorted(r["name"] for r in back.collect()) == [f"n{b}-{k}" for b in range(4) for k in range(3)]


def test_latest_stored_date_reads_the_newest_month_alone(spark, tmp_path):
    from perigee import sources
    from perigee.schema import FLAT_SCHEMA

    path = str(tmp_path / "flat")
    assert sources.latest_stored_date(spark, path).first()["latest"] is None
    days = ["2023-11-05", "2024-01-05", "2024-01-09", "x", None]
    rows = [(f"n{k}", day, 1.0, 1.0, 1.0, 1.0, 0.0) for k, day in enumerate(days)]
    sources.write_flat(spark.createDataFrame(rows, FLAT_SCHEMA), path)
    found = sources.latest_stored_date(spark, path)
    assert str(found.first()["latest"]) == "2024-01-09"
    (tmp_path / "flat" / "approach_month=2025-01-01").mkdir()
    assert str(sources.latest_stored_date(spark, path).first()["latest"]) == "2024-01-09"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "approach_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
