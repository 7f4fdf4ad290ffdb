"""Steps whose cost has to follow the input: what moves, what is computed again, what one task gets."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import __spark_entry__ as registry
import samplefeed
from perigee import operators as op
from perigee import plans
from perigee.schema import FLAT_COLUMNS, LEDGER_SCHEMA


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with a lineitem table of 400 rows."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [
        (k, k % 50, k % 7 + 1, float(k % 50), 1000.0 + 997.0 * (k % 100), datetime(1998, 1, 1) + timedelta(9 * k % 1800))
        for k in range(1, 401)
    ]
    schema = (
        "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP"
    )
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_does_not_deal_in_turns(spark, tables):
    assert "RoundRobin" not in _plan(samplefeed.messages(spark, tables))


def test_spread_deals_by_rows_and_parts_copies(spark, tmp_path, monkeypatch):
    """The tasks that make messages follow the count of rows, also where all rows are copies of one."""
    from samplefeed import build

    monkeypatch.setattr(build, "MOST_ROWS", 50, raising=False)
    row = (7, 7, 1, 7.0, 1000.0, datetime(1998, 1, 1))
    schema = (
        "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP"
    )
    spark.createDataFrame([row] * 1000, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    dealt = samplefeed.messages(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    sizes = [size for _, size in dealt]
    assert sum(sizes) == 1000 and len(sizes) == 20 and max(sizes) < 100


def test_envelopes_move_narrow_rows_once(spark, tables):
    plan = _plan(samplefeed.envelopes(spark, tables))
    assert plan.count("Exchange") == 1
    assert "neo-" not in plan.partition("Exchange")[2]


def test_bounded_grid_stores_its_points(spark, tables, tmp_path):
    display = op.display_rows(registry._scored(spark, tables))
    stored = op.bounded_grid(display, 5, 4, path=str(tmp_path / "points"))
    assert "from_json" not in _plan(stored)
    assert sorted(stored.collect()) == sorted(op.bounded_grid(display, 5, 4).collect())
    assert "from_json" not in _plan(registry.scatter_grid_bounded(spark, tables))


def test_export_new_spreads_a_batch(spark, tmp_path, monkeypatch):
    """A batch is not gathered in one task by the join with the list, before the rebalance that could split it."""
    scored = spark.range(0, 1000, 1, 8).select("id", F.lit(0).cast("bigint").alias("batch_id"))
    scored.write.parquet(str(tmp_path / "scored"))
    scored = spark.read.parquet(str(tmp_path / "scored"))
    plans, hint = [], type(scored).hint
    monkeypatch.setattr(type(scored), "hint", lambda rows, name, *on: (name == "rebalance" and plans.append(_plan(rows)), hint(rows, name, *on))[1])
    assert op.export_new(scored, str(tmp_path / "out")) == [0]
    assert len(plans) == 1 and "hashpartitioning(batch_id" not in plans[0]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_late_step_decodes_once(spark, tables, monkeypatch):
    plans = []
    write = registry.sources.write_flat
    monkeypatch.setattr(registry.sources, "write_flat", lambda rows, path: (plans.append(_plan(rows)), write(rows, path)))
    registry.step_late_ledger(spark, tables)
    assert len(plans) == 2 and not any("from_json" in plan for plan in plans)


@pytest.mark.parametrize("name", ["model_fit", "model_refit", "model_refit_newton"])
def test_fits_read_stored_splits(spark, tables, monkeypatch, name):
    plans = []
    fit = registry.op.fit
    monkeypatch.setattr(registry.op, "fit", lambda train: (plans.append(_plan(train)), fit(train))[1])
    getattr(registry, name)(spark, tables).collect()
    assert plans and not any("md5" in plan for plan in plans)


def _flat_rows(spark, n=800, parts=4):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int"))
    text = F.when(F.col("id") % 40 != 0, day.cast("string"))
    sizes = [F.lit(float(k)).alias(name) for k, name in enumerate(FLAT_COLUMNS[2:], 1)]
    name = F.concat(F.lit("n"), "id").alias("name")
    return spark.range(0, n, 1, parts).select(name, text.alias("close_approach_date"), *sizes)


def test_step_stages_without_a_shuffle(spark, tmp_path):
    """Rows are written by the tasks that read them: moved by part they would meet in a few tasks."""
    paths = plans.StatePaths(str(tmp_path / "state"))
    batch = op.with_day(_flat_rows(spark))
    row = plans.process_batch(batch, 0, paths, trainer=lambda train: registry.FIXED)
    assert (row["n_rows"], row["n_rejected"]) == (800, 20)
    for part in ("train", "test"):
        folder = Path(paths.rows) / "batch_id=0" / f"part={part}"
        assert len(list(folder.glob("*.parquet"))) == 4
    assert plans.read_train(spark, paths).select("name").distinct().count() == row["n_train"]


def test_undated_and_late_rows_open_their_months_alone(spark, tmp_path, monkeypatch):
    from perigee.plans import step

    read, opened = step.rows_of_files, []
    monkeypatch.setattr(step, "rows_of_files", lambda table, *of: (opened.append(_plan(table)), read(table, *of))[1])
    paths = plans.StatePaths(str(tmp_path / "state"))
    counts = []
    for k in range(2):
        registry.sources.write_flat(_flat_rows(spark).withColumn("name", F.concat("name", F.lit(f"-{k}"))), paths.flat)
        row = plans.run_available(
            spark, paths, initial=date(2024, 1, 10), until=date(2024, 2, 10 + 9 * k), trainer=lambda train: registry.FIXED
        )
        counts.append((row["n_rows"], row["n_rejected"], row["n_late"]))
    filters = [plan.partition("PartitionFilters: [")[2].partition("]")[0] for plan in opened]
    assert len(filters) == 2 and all("isnull(approach_month" in f for f in filters)
    dates = _flat_rows(spark).selectExpr("to_date(close_approach_date) AS d")
    undated, first, second = dates.selectExpr(
        "count_if(d IS NULL)", "count_if(d > '2024-01-10' AND d <= '2024-02-10')", "count_if(d > '2024-02-10' AND d <= '2024-02-19')"
    ).first()
    assert counts == [(first + undated, undated, 0), (2 * second + first + undated, undated, first)]


def _shuffle_files(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(disk.size()) if (name := disk.apply(k).getName()).startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files that are new and stay: they are deleted in the background."""
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def _root(spark, monkeypatch, tmp_path) -> Path:
    monkeypatch.setattr(plans, "shared_root", lambda _: str(tmp_path / "root"))
    return tmp_path / "root"


def _bytes(folder: Path) -> int:
    return sum(f.stat().st_size for f in folder.rglob("part-*"))


def test_roundtrip_packs_what_it_stores(spark, tables, tmp_path, monkeypatch):
    """Neither the messages' plain text nor the shuffled rows stay on disk."""
    root, before = _root(spark, monkeypatch, tmp_path), _shuffle_files(spark)
    flat = registry.feed_roundtrip(spark, tables)
    assert not _left(spark, before)
    lines = registry.sources.read_messages(spark, "text", {"path": f"{root}/messages"})
    n, size = lines.agg(F.count("*"), F.sum(F.length("value"))).first()
    assert n == flat.count() == 400 and _bytes(root / "messages") < size / 5
    envelopes = registry.sources.read_envelopes(spark, f"{root}/envelopes", "parquet")
    assert all(".zstd." in name for (name,) in envelopes.select(F.input_file_name()).distinct().collect())


def test_streamed_fan_out_leaves_no_shuffles(spark, tables, tmp_path, monkeypatch):
    """Envelopes moved whole by a micro-batch are gone when it ends; what is published is packed; the feed is made once."""
    root, before, left = _root(spark, monkeypatch, tmp_path), _shuffle_files(spark), []
    start = registry.streaming.start_fan_out

    def ended(*args):
        (query := start(*args)).awaitTermination(120)
        left.append(_left(spark, before))
        return query

    monkeypatch.setattr(registry.streaming, "start_fan_out", ended)
    landed, land = [], registry._land
    monkeypatch.setattr(registry, "_land", lambda s, rows, path: (landed.append(_plan(rows)), land(s, rows, path))[1])
    flat = registry.stream_fan_out(spark, tables)
    assert left == [set(), set()] and ["Exchange" in plan for plan in landed] == [True, False, False]
    assert not (root / "made").exists()
    assert flat.count() == flat.select("name").distinct().count() == 400
    names = spark.read.parquet(f"{root}/fanned").select(F.input_file_name()).distinct().collect()
    assert names and all(".zstd." in name for (name,) in names)


def test_dropping_shuffles_keeps_the_setting(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), plans.shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        1 / 0
    assert spark.conf.get(key) == before


def test_empty_state_starts_no_python(spark, tmp_path):
    paths = plans.StatePaths(str(tmp_path / "state"))
    for table in (plans.read_ledger(spark, paths), plans.read_train(spark, paths), plans.read_scored(spark, paths)):
        assert "ExistingRDD" not in _plan(table) and table.count() == 0
    assert plans.read_ledger(spark, paths).columns == [f.name for f in StructType.fromDDL(LEDGER_SCHEMA).fields]
