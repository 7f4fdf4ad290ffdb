"""Objects with many approaches: one order is one object, its lineitems its approaches.

Small data only: all approaches of an order are gathered into one list, which no registered query does.
"""

from datetime import date

import pytest
from pyspark.sql import functions as F

from perigee import operators as op
from perigee import sources
from perigee.schema import FEATURE_COLUMNS, FLAT_COLUMNS
from tests.comparing import assert_same, duck

MEDIUM = "/root/testdata/sf0.01"

FLAT = """
WITH first_approach AS (
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS rn
    FROM lineitem l) WHERE rn = 1)
SELECT
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE 'neo-' || o_orderkey END AS name,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS close_approach_date,
  CASE WHEN o_orderkey % 211 = 0 OR o_orderkey % 101 = 0 THEN NULL
       ELSE o_totalprice / 100000.0::DOUBLE END AS estimated_diameter_km_max,
  CASE WHEN o_orderkey % 211 = 0 OR o_orderkey % 101 = 0 THEN NULL
       ELSE o_totalprice / 100000.0::DOUBLE / 2.236::DOUBLE END AS estimated_diameter_km_min,
  CASE WHEN o_orderkey % 211 = 0 OR o_orderkey % 89 = 0 THEN NULL ELSE l_quantity END AS relative_velocity_km_s,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE l_extendedprice END AS miss_distance_km,
  CASE WHEN o_orderkey % 211 <> 0 AND o_orderkey % 97 <> 0 AND ((o_totalprice > 300000) <> (o_orderkey % 23 = 0))
       THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_potentially_hazardous_asteroid
FROM orders LEFT JOIN first_approach ON o_orderkey = l_orderkey
"""


def every(n):
    return F.col("o_orderkey") % n == 0


@pytest.fixture(scope="module")
def messages(spark):
    lineitem = spark.read.parquet(f"{MEDIUM}/lineitem.parquet")
    keys = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    lists = lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("lines"))
    approaches = F.transform(
        "lines",
        lambda line: F.struct(
            line["l_shipdate"].cast("date").cast("string").alias("close_approach_date"),
            F.struct(
                F.when(every(89), "n/a").otherwise(line["l_quantity"].cast("string")).alias("kilometers_per_second")
            ).alias("relative_velocity"),
            F.struct(line["l_extendedprice"].cast("string").alias("kilometers")).alias("miss_distance"),
        ),
    )
    largest = F.when(~every(101), F.col("o_totalprice") / 100000.0)
    orders = spark.read.parquet(f"{MEDIUM}/orders.parquet")
    objects = orders.join(lists, orders["o_orderkey"] == lists["l_orderkey"], "left").select(
        "o_orderkey",
        F.concat(F.lit("neo-"), "o_orderkey").alias("name"),
        F.when(~every(97), (F.col("o_totalprice") > 300000) != every(23)).alias("is_potentially_hazardous_asteroid"),
        F.struct(
            F.struct(
                largest.alias("estimated_diameter_max"), (largest / 2.236).alias("estimated_diameter_min")
            ).alias("kilometers")
        ).alias("estimated_diameter"),
        F.coalesce(approaches, F.array()).alias("close_approach_data"),
    )
    encoded = sources.encode(objects, keep=["o_orderkey"])
    return encoded.select(F.when(every(211), F.substring("value", 1, 20)).otherwise(F.col("value")).alias("value"))


def test_flat_rows(spark, messages):
    flat = op.flatten(messages)
    assert assert_same(flat, duck(MEDIUM), FLAT) == 15000
    counts = flat.agg(*(F.count(c) for c in FLAT_COLUMNS[:5]), F.sum(FLAT_COLUMNS[-1])).first()
    assert tuple(counts) == (14928, 14673, 14780, 14780, 14509, 6099.0)


def test_known_counts(spark, messages):
    dated = op.with_day(op.flatten(messages)).cache()
    clean = op.clean_rows(dated)
    assert op.newer_than(dated, date(2000, 1, 1)).count() == 3933
    assert clean.count() == 14364
    assert op.late_rows(clean, date(2000, 1, 1)).count() == 10509
    assert op.split_keyed(clean).where("is_train").count() == 11397
    assert op.assemble(clean.select(*FEATURE_COLUMNS)).count() == 14364
    assert op.reject_counts(dated).count() == 3
    scored = op.score_linear(clean, (0.0, 1.0, 0.0, 0.0), -3.0)
    assert op.scatter_grid(op.display_rows(scored), 10000, 0.25).count() == 198
    assert op.confusion_counts(op.display_rows(scored)).count() == 4
    dated.unpersist()
