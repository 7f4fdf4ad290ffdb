"""Bad and odd messages, in batch and in a stream."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from perigee import operators as op
from perigee import sources, streaming
from perigee.functions import class_text, day, keyed_bucket, to_day, to_double
from perigee.schema import FLAT_COLUMNS, FLAT_SCHEMA

EMPTY = (None, None, None, None, None, None, 0.0)


def approach(day="2024-01-05", velocity="7.5", miss="100"):
    return (
        f'{{"close_approach_date":"{day}","relative_velocity":{{"kilometers_per_second":"{velocity}"}},'
        f'"miss_distance":{{"kilometers":"{miss}"}}}}'
    )


def diameter(largest, smallest):
    return f'{{"kilometers":{{"estimated_diameter_max":{largest},"estimated_diameter_min":{smallest}}}}}'


CASES = [
    (None, EMPTY),
    ("zzz", EMPTY),
    ('{"name":"m"', EMPTY),
    ("[]", EMPTY),
    ('{"name":"e","close_approach_data":[]}', ("e", *EMPTY[1:])),
    ('{"name":"n"}', ("n", *EMPTY[1:])),
    ('{"name":"l","close_approach_data":null}', ("l", *EMPTY[1:])),
    ('{"name":5}', ("5", *EMPTY[1:])),
    (
        f'{{"name":"v","close_approach_data":[{approach(velocity="abc")}]}}',
        ("v", "2024-01-05", None, None, None, 100.0, 0.0),
    ),
    (
        f'{{"name":"x","is_potentially_hazardous_asteroid":"yes","estimated_diameter":{diameter(chr(34) + "x" + chr(34), 2.0)}}}',
        ("x", None, None, 2.0, None, None, 0.0),
    ),
    (
        f'{{"name":"two","is_potentially_hazardous_asteroid":true,"unlisted":{{"a":[1]}},'
        f'"estimated_diameter":{diameter(2.5, 1.5)},'
        f'"close_approach_data":[{approach()},{approach(day="2030-01-01", velocity="1", miss="2")}]}}',
        ("two", "2024-01-05", 2.5, 1.5, 7.5, 100.0, 1.0),
    ),
    (
        f'{{"name":"né\\n","is_potentially_hazardous_asteroid":false,"close_approach_data":[{approach(day="2024-1-5")}]}}',
        ("né\n", "2024-1-5", None, None, 7.5, 100.0, 0.0),
    ),
]


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def as_messages(spark, cases=CASES):
    return spark.createDataFrame([(text,) for text, _ in cases], "value STRING").select(
        F.col("value").cast("binary").alias("value")
    )


@pytest.mark.parametrize("text,expected", CASES, ids=range(len(CASES)))
def test_one_message(spark, text, expected):
    flat = op.flatten(spark.createDataFrame([(text,)], "value STRING"))
    assert [tuple(row) for row in flat.collect()] == [expected]


def test_flat_shape(spark):
    flat = op.flatten(as_messages(spark))
    assert flat.columns == FLAT_COLUMNS
    assert flat.schema.simpleString() == spark.createDataFrame([], FLAT_SCHEMA).schema.simpleString()


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_stream_equals_batch(spark, tmp_path, fmt):
    # A text directory has one message per line and no null messages.
    cases = [case for case in CASES if fmt == "parquet" or case[0] is not None]
    inbox = {"path": f"{tmp_path}/inbox"}
    sources.publish(as_messages(spark, cases), fmt, inbox)
    streaming.run_flat_stream(spark, f"{tmp_path}/flat", f"{tmp_path}/checkpoint", fmt, inbox)
    stored = sources.read_flat(spark, f"{tmp_path}/flat").select(*FLAT_COLUMNS)
    assert ordered(stored.collect()) == ordered(expected for _, expected in cases)
    batch = op.flatten(sources.read_messages(spark, fmt, inbox))
    assert ordered(batch.collect()) == ordered(stored.collect())


def test_reject_reasons(spark):
    rows = [
        ("ok", "2024-01-05", 2.0, 1.0, 3.0, 4.0, 1.0),
        (None, "2024-01-05", 2.0, 1.0, 3.0, 4.0, 1.0),
        ("loose", "2024-1-5", 2.0, 1.0, 3.0, 4.0, 1.0),
        ("none", None, None, 1.0, 3.0, 4.0, 1.0),
        ("feature", "2024-01-05", None, 1.0, 3.0, 4.0, 1.0),
        ("nan", "2024-01-05", 2.0, 1.0, float("nan"), 4.0, 1.0),
        ("unlabelled", "2024-01-05", 2.0, 1.0, 3.0, 4.0, 0.0),
    ]
    dated = op.with_day(spark.createDataFrame(rows, FLAT_SCHEMA))
    assert {row["name"]: row["reason"] for row in op.rejects(dated).collect()} == {
        None: "undecodable",
        "loose": "no_date",
        "none": "no_date",
        "feature": "no_feature",
        "nan": "no_feature",
    }
    assert {row["name"] for row in op.clean_rows(dated).collect()} == {"ok", "unlabelled"}
    assert {row["reason"]: row["count"] for row in op.reject_counts(dated).collect()} == {
        "undecodable": 1,
        "no_date": 2,
        "no_feature": 2,
    }


def test_json_is_parsed_once_behind_a_filter(spark):
    clean = op.clean_rows(op.with_day(op.flatten(as_messages(spark))))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_scalars(spark):
    texts = [("2024-01-05",), ("2024-1-5",), ("2024",), ("2024-01-05 10:00",), ("2024-02-30",), ("",), (None,)]
    days = spark.createDataFrame(texts, "t STRING").select(to_day(F.col("t"))).collect()
    assert [row[0] for row in days] == [date(2024, 1, 5)] + [None] * 6
    numbers = spark.createDataFrame([("1.5",), (" 2 ",), ("1e3",), ("n/a",), ("",), (None,)], "t STRING")
    assert [row[0] for row in numbers.select(to_double(F.col("t"))).collect()] == [1.5, 2.0, 1000.0, None, None, None]
    classes = spark.createDataFrame([(1.0,), (0.0,), (2.0,), (None,)], "x DOUBLE").select(class_text(F.col("x")))
    assert [row[0] for row in classes.collect()] == ["Hazardous"] + ["Not Hazardous"] * 3
    assert spark.range(1).select(day(date(1, 1, 1)).cast("string")).first()[0] == "0001-01-01"


def test_keyed_bucket_is_the_md5_rule(spark):
    import hashlib

    names = [f"n{i}" for i in range(200)] + ["", "é"]
    rows = spark.createDataFrame([(n,) for n in names], "n STRING").select(keyed_bucket(F.col("n"))).collect()
    assert [row[0] for row in rows] == [int(hashlib.md5(n.encode()).hexdigest()[:8], 16) % 100 for n in names]
