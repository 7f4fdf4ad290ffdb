"""A third of all rows copies of one row: results stay whole and no task gathers the copies."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tests.comparing import assert_same, duck

SMALL = "/root/testdata/sf0.001"
QUERIES = [
    "feed_date_counts",
    "feed_envelope_explode",
    "feed_windows_pending",
    "stream_flatten",
    "latest_rows",
    "train_accumulate",
    "batch_ledger",
    "batch_rejects",
    "step_stream_ledger",
    "scatter_grid",
    "scored_export",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    one = rows.where("l_orderkey = 2").orderBy("l_linenumber").limit(1)
    copies = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("copy")
    rows.unionByName(copies).coalesce(1).write.parquet(f"{folder}/parts")
    [file] = (folder / "parts").glob("*.parquet")
    (folder / "lineitem.parquet").write_bytes(file.read_bytes())
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_copies_are_all_kept(spark, skewed, name):
    assert_same(registry.queries()[name](spark, skewed), duck(skewed), registry.oracle_sql()[name])


def test_large_groups_are_written_in_several_files(spark, tmp_path, monkeypatch):
    from perigee import sources
    from perigee.sources import tables

    monkeypatch.setattr(tables, "MAX_FILE_ROWS", 100)
    flat = registry.flatten(spark, SMALL).withColumn("close_approach_date", F.lit("2024-01-05"))
    sources.write_flat(flat, f"{tmp_path}/flat")
    stored = sources.read_flat(spark, f"{tmp_path}/flat")
    per_file = stored.groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()
    assert tuple(per_file) == (100, 6000)


@pytest.mark.parametrize("streamed", [False, True])
def test_a_month_too_large_for_one_task_is_split(spark, tmp_path, streamed):
    from perigee import operators as op
    from perigee import sources, streaming

    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("name")
    )
    first = F.array(F.struct(F.lit("2024-01-05").alias("close_approach_date")))
    messages = sources.encode(rows.repartition(8).withColumn("close_approach_data", first))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "16k")
    try:
        if streamed:
            inbox = {"path": f"{tmp_path}/inbox"}
            sources.publish(messages, "parquet", inbox)
            streaming.run_flat_stream(spark, f"{tmp_path}/flat", f"{tmp_path}/checkpoint", "parquet", inbox)
        else:
            sources.write_flat(op.flatten(messages), f"{tmp_path}/flat")
    finally:
        spark.conf.unset(key)
    stored = sources.read_flat(spark, f"{tmp_path}/flat")
    assert stored.count() == 6000
    assert stored.select(F.input_file_name()).distinct().count() > 2


PLAIN = ["flatten", "first_element", "label_encode", "split_keyed", "score_linear", "display_rows", "scatter_points"]


@pytest.mark.parametrize("name", PLAIN)
def test_row_wise_queries_do_not_shuffle(spark, name):
    plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    # The feed deals its rows over the cores; the library adds nothing to that.
    assert plan.count("Exchange") == plan.count("Exchange RoundRobinPartitioning") == 1
    assert plan.count("from_json(") == 1
