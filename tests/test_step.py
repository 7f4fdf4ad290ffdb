"""The incremental step and its state."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import samplefeed
from perigee import operators as op
from perigee import plans, sources, streaming
from perigee.plans.state import of_batch, read_rows, read_sources, read_start
from perigee.schema import FLAT_SCHEMA

SMALL = "/root/testdata/sf0.001"
START = date(1, 1, 1)
FIXED = op.LinearModel((0.0, 1.0, 0.0, 0.0), -3.0)
ENDS = [date(1996, 12, 31), date(1998, 6, 30), date(1998, 7, 1), date(2001, 12, 31)]


def fixed(train):
    return FIXED


@pytest.fixture(scope="module")
def flat_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "flat")
    sources.write_flat(op.flatten(samplefeed.messages(spark, SMALL)), path)
    return path


@pytest.fixture
def paths(tmp_path, flat_path):
    return type("Paths", (plans.StatePaths,), {"flat": flat_path})(str(tmp_path / "state"))


def replay(spark, paths, ends=ENDS, **settings):
    settings.setdefault("trainer", fixed)
    return [plans.run_available(spark, paths, initial=START, until=end, **settings) for end in ends]


def state(spark, paths):
    ledger = plans.read_ledger(spark, paths).orderBy("batch_id").collect()
    train = sorted(plans.read_train(spark, paths).select("batch_id", "name", "approach_date").collect())
    scored = sorted(plans.read_scored(spark, paths).select("batch_id", "name", "prediction").collect())
    return ledger, train, scored


def test_rows_are_used_once_and_counts_add_up(spark, paths):
    rows = replay(spark, paths)
    flat = sources.read_flat(spark, paths.flat)
    dated = flat.where("approach_date IS NOT NULL")
    clean = op.clean_rows(flat)
    assert sum(row["n_rows"] for row in rows) == flat.count()
    assert rows[1]["n_rows"] + rows[2]["n_rows"] < dated.count()  # undated rows came with the first batch
    assert sum(row["n_train"] + row["n_test"] for row in rows) == clean.count()
    train = plans.read_train(spark, paths)
    assert rows[-1]["total_train"] == train.count()
    keys = ["name", "approach_date", "miss_distance_km", "estimated_diameter_km_max"]
    expected = op.split_keyed(clean).where("is_train").select(*keys)
    assert train.select(*keys).exceptAll(expected).isEmpty()
    assert expected.exceptAll(train.select(*keys)).isEmpty()
    for row, end in zip(rows, ENDS, strict=True):
        assert row["n_rows"] == row["n_rejected"] + row["n_train"] + row["n_test"]
        assert row["cursor_date"] <= end
    assert read_rows(spark, paths, "reject").count() == sum(row["n_rejected"] for row in rows)


def test_no_new_rows_change_nothing(spark, paths):
    replay(spark, paths, ENDS[:1])
    before = state(spark, paths)
    assert replay(spark, paths, ENDS[:1]) == [None]
    assert state(spark, paths) == before


def test_rerun_of_a_batch_changes_nothing(spark, paths):
    replay(spark, paths)
    before = state(spark, paths)
    flat = sources.read_flat(spark, paths.flat)
    for i in (1, len(ENDS) - 1):
        plans.process_batch(op.newer_than(flat, before[0][i - 1]["cursor_date"], ENDS[i]), i, paths, fixed)
    assert state(spark, paths) == before


def test_a_batch_that_failed_is_not_read_and_can_be_retried(spark, paths):
    replay(spark, paths, ENDS[:1])
    before = state(spark, paths)

    def broken(train):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        replay(spark, paths, ENDS[1:2], trainer=broken)
    assert spark.read.parquet(of_batch(paths.rows, 1)).count() > 0
    assert state(spark, paths) == before
    [row] = replay(spark, paths, ENDS[1:2])
    assert row["batch_id"] == 1
    assert row["total_train"] == plans.read_train(spark, paths).count()


def test_cursor_from_the_test_part(spark, paths):
    [row] = replay(spark, paths, ENDS[:1], cursor_from="test")
    scored = plans.read_scored(spark, paths, latest_only=True)
    assert row["cursor_date"] == op.latest_date(scored).first()["latest"]
    with pytest.raises(ValueError):
        replay(spark, paths, ENDS[1:2], cursor_from="train")


def test_empty_test_part_keeps_the_cursor(spark, paths):
    rows = [("a", "2024-01-05", None, 1.0, 3.0, 4.0, 1.0)]
    rejected = op.with_day(spark.createDataFrame(rows, FLAT_SCHEMA))
    first = plans.process_batch(rejected, 0, paths, fixed, cursor_from="test")
    assert (first["n_rejected"], first["total_train"]) == (1, 0)
    assert first["cursor_date"] is None and first["accuracy"] is None and first["intercept"] is None
    ledger = plans.read_ledger(spark, paths)
    assert plans.read_cursor(ledger, date(2024, 1, 1)) == date(2024, 1, 1)
    assert plans.read_model(ledger) is None
    second = plans.process_batch(rejected, 1, paths, fixed)
    assert second["cursor_date"] == date(2024, 1, 5)


def test_batches_of_one_part_only(spark, paths):
    import hashlib

    def bucket(name):
        return int(hashlib.md5(name.encode()).hexdigest()[:8], 16) % 100

    names = [f"n{i}" for i in range(60)]

    def batch(day, chosen):
        rows = [(n, day, float(i % 7), 1.0, 3.0, float(i), float(i % 2)) for i, n in enumerate(chosen)]
        return op.with_day(spark.createDataFrame(rows, FLAT_SCHEMA))

    train = [n for n in names if bucket(n) < 80]
    test = [n for n in names if bucket(n) >= 80]
    first = plans.process_batch(batch("2024-01-05", train), 0, paths)
    assert (first["n_train"], first["n_test"], first["accuracy"]) == (len(train), 0, None)
    second = plans.process_batch(batch("2024-01-06", test), 1, paths, look_back=0)
    assert (second["n_train"], second["n_test"]) == (0, len(test))
    assert second["coefficients"] == first["coefficients"] and second["intercept"] == first["intercept"]
    assert second["total_train"] == len(train) and second["accuracy"] is not None
    assert plans.read_scored(spark, paths, latest_only=True).count() == len(test)


def test_before_the_first_batch(spark, paths):
    ledger = plans.read_ledger(spark, paths)
    assert plans.latest_batch(ledger) is None
    assert plans.read_scored(spark, paths, latest_only=True).isEmpty()
    assert plans.read_train(spark, paths).isEmpty()
    assert plans.run_summary(ledger).first()["total_points"] is None
    # Without an initial cursor a run starts yesterday: nothing in the table is that new, but what has no date.
    row = plans.run_available(spark, paths)
    assert row["n_rows"] == row["n_rejected"] > 0 and row["cursor_date"] is None
    assert plans.run_available(spark, paths) is None


def test_summary_and_latest_results(spark, paths):
    rows = replay(spark, paths)
    summary = plans.run_summary(plans.read_ledger(spark, paths)).first()
    assert summary["start_date"] == rows[0]["first_date"]
    assert summary["end_date"] == rows[-1]["cursor_date"] - timedelta(days=1)
    assert summary["next_from"] == rows[-1]["cursor_date"] + timedelta(days=1)
    assert (summary["total_points"], summary["accuracy"]) == (rows[-1]["total_train"], rows[-1]["accuracy"])
    given = plans.run_summary(plans.read_ledger(spark, paths), date(1990, 1, 1)).first()
    assert given["start_date"] == date(1990, 1, 1)
    latest = plans.read_scored(spark, paths, latest_only=True)
    assert latest.count() == rows[-1]["n_test"]
    assert {row["batch_id"] for row in latest.select("batch_id").distinct().collect()} == {3}
    assert op.accuracy(latest).first()["accuracy"] == rows[-1]["accuracy"]


def test_refit_sees_all_batches_or_the_last_few(spark, paths):
    seen = []

    def counting(train):
        seen.append(train.count())
        return FIXED

    rows = replay(spark, paths, trainer=counting)
    assert seen == [row["total_train"] for row in rows]
    seen.clear()
    flat = sources.read_flat(spark, paths.flat)
    batch = op.newer_than(flat, rows[-2]["cursor_date"], ENDS[-1])
    row = plans.process_batch(batch, 4, paths, counting, look_back=2)
    assert seen == [rows[-2]["n_train"] + 2 * rows[-1]["n_train"]]
    assert row["n_fitted"] == seen[0] and row["total_train"] == rows[-1]["total_train"] + row["n_train"]


def test_a_finished_batch_is_never_written_again(spark, paths):
    """As when a stream stops between the ledger row and its checkpoint: fewer rows, a broken trainer."""
    rows = replay(spark, paths, ENDS[:2])
    before = state(spark, paths)

    def broken(train):
        raise RuntimeError("lost")

    fewer = sources.read_flat(spark, paths.flat).where("estimated_diameter_km_max > 2")
    for batch_id in (0, 1):
        assert plans.process_batch(fewer, batch_id, paths, broken) == rows[batch_id]
    assert state(spark, paths) == before


def test_undated_rows_are_staged_once(spark, tmp_path):
    paths = plans.StatePaths(str(tmp_path / "state"))
    good = [(f"n{i}", f"2024-01-{5 + i % 9:02d}", 1.0 + i, 1.0, 3.0, 4.0, float(i % 2)) for i in range(40)]
    bad = [(None,) * 6 + (0.0,), ("loose", "2024-1-5", 1.0, 1.0, 3.0, 4.0, 0.0), ("v", "2024-01-05", 1.0, 1.0, None, 4.0, 0.0)]
    seen = []
    for added in (good + bad, [], bad[:2], bad):
        if added:
            sources.write_flat(spark.createDataFrame(added, FLAT_SCHEMA).coalesce(1), paths.flat)
        seen.append(plans.run_available(spark, paths, initial=START, trainer=fixed))
    counts = [row and (row["n_rows"], row["n_rejected"], row["n_late"]) for row in seen]
    assert counts == [(43, 3, 0), None, (2, 2, 0), (3, 2, 1)]  # the last file's dated row came too late
    assert {row["cursor_date"] for row in seen if row} == {date(2024, 1, 13)}
    reasons = read_rows(spark, paths, "reject").groupBy("reason").count().collect()
    assert dict(map(tuple, reasons)) == {"undecodable": 3, "no_date": 3, "no_feature": 1}


@pytest.mark.parametrize("velocity", ["1e999", "Infinity", "-Infinity", "NaN"])
def test_a_feature_that_is_no_number_stops_nothing(spark, tmp_path, velocity):
    paths = plans.StatePaths(str(tmp_path / "state"))
    fields = "name STRING, v STRING"
    rows = spark.createDataFrame([(f"n{i}", velocity if i % 4 == 0 else str(i)) for i in range(200)], fields)
    approach = F.struct(
        F.lit("2024-01-05").alias("close_approach_date"),
        F.struct(F.col("v").alias("kilometers_per_second")).alias("relative_velocity"),
        F.struct(F.lit("5").alias("kilometers")).alias("miss_distance"),
    )
    size = F.struct(F.struct(F.lit(2.0).alias("estimated_diameter_max"), F.lit(1.0).alias("estimated_diameter_min")).alias("kilometers"))
    messages = rows.select(
        "name", (F.length("name") == 3).alias("is_potentially_hazardous_asteroid"),
        size.alias("estimated_diameter"), F.array(approach).alias("close_approach_data"),
    )
    inbox = {"path": f"{tmp_path}/inbox"}
    sources.publish(sources.encode(messages), "parquet", inbox)
    streaming.run_flat_stream(spark, paths.flat, paths.checkpoint("flat"), "parquet", inbox)
    row = plans.run_available(spark, paths, initial=START)
    assert (row["n_rows"], row["n_rejected"]) == (200, 50) and row["accuracy"] is not None


def test_merged_state_reads_the_same(spark, paths, monkeypatch):
    rows = replay(spark, paths, ENDS[:3])
    before = state(spark, paths)
    assert plans.merge(spark, paths) == plans.merge(spark, paths) == 2
    assert state(spark, paths) == before
    replay(spark, paths, ENDS[3:])
    assert plans.read_ledger(spark, paths).count() == 4
    after = state(spark, paths)
    assert plans.merge(spark, paths) == 3 and state(spark, paths) == after
    assert replay(spark, paths, ENDS[3:]) == [None]
    assert plans.process_batch(sources.read_flat(spark, paths.flat), 1, paths, fixed) == rows[1]


def test_many_small_batches_leave_few_folders(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from perigee.plans import state as module

    monkeypatch.setattr(module, "MERGE_EVERY", 5)
    paths = plans.StatePaths(str(tmp_path / "state"))
    for i in range(17):
        rows = [(f"n{i}-{k}", "2024-01-05", float(k), 1.0, 3.0, 4.0, 0.0) for k in range(6)]
        plans.process_batch(op.with_day(spark.createDataFrame(rows, FLAT_SCHEMA).coalesce(1)), i, paths, fixed)
        assert len(list(Path(paths.ledger).glob("batch_id=*"))) < 5
        assert len(plans.read_ledger(spark, paths).inputFiles()) < 2 * 5  # of each level fewer than five
    ledger = plans.read_ledger(spark, paths).orderBy("batch_id").collect()
    assert [row["batch_id"] for row in ledger] == list(range(17))
    assert ledger[-1]["total_train"] == sum(row["n_train"] for row in ledger) == plans.read_train(spark, paths).count()


@pytest.mark.parametrize("files", [None, "20", "90"])
def test_cutting_a_backlog_changes_no_total(spark, tmp_path, flat_path, files):
    paths = plans.StatePaths(str(tmp_path / "state"))
    flat = sources.read_flat(spark, flat_path).drop("approach_date", "approach_month")
    for part in range(3):  # each with all dates
        sources.write_flat(flat.where(F.pmod(F.hash("name"), F.lit(3)) == part), paths.flat)
    options = {"maxFilesPerTrigger": files} if files else None
    streaming.start_step_stream(spark, paths, START, options=options, trainer=fixed).awaitTermination(300)
    sums = plans.read_ledger(spark, paths).agg(F.count("*"), *(F.sum(c) for c in ("n_rows", "n_rejected", "n_late"))).first()
    clean = op.clean_rows(flat.transform(op.with_day)).count()
    assert tuple(sums)[1:] == (6000, 6000 - clean, 0) and (sums[0] > 1) == (files is not None)


def test_late_rows_are_set_aside_and_counted_when_wanted(spark, paths):
    def batch(*days):
        rows = [(f"n{i}", day, float(i), 1.0, 3.0, 4.0, 0.0) for i, day in enumerate(days)]
        return op.with_day(spark.createDataFrame(rows, FLAT_SCHEMA))

    first = plans.process_batch(batch("2024-01-05", "2024-01-09"), 0, paths, fixed, drop_late=True)
    second = plans.process_batch(batch("2024-01-07", "2024-01-09", "2024-01-10"), 1, paths, fixed, drop_late=True)
    third = plans.process_batch(batch("2024-01-01", "2024-01-02"), 2, paths, fixed)
    assert [row["n_late"] for row in (first, second, third)] == [0, 2, 0]
    assert read_rows(spark, paths, "late").count() == 2
    assert third["n_train"] + third["n_test"] == 2 and third["cursor_date"] == second["cursor_date"]


def test_step_stream_equals_steps(spark, tmp_path, flat_path):
    """Two micro-batches of new flat rows give two batches; a restart adds none."""
    paths = plans.StatePaths(str(tmp_path / "state"))
    flat = sources.read_flat(spark, flat_path).drop("approach_date", "approach_month")
    early = F.col("close_approach_date") < "1998"
    ledger = []
    for part in (flat.where(early), flat.where(~early)):
        sources.write_flat(part, paths.flat)
        query = streaming.start_step_stream(spark, paths, START, trainer=fixed)
        query.awaitTermination(120)
        ledger.append(plans.read_ledger(spark, paths).orderBy("batch_id").collect())
    streaming.start_step_stream(spark, paths, START, trainer=fixed).awaitTermination(120)
    assert plans.read_ledger(spark, paths).orderBy("batch_id").collect() == ledger[1]
    assert [row["batch_id"] for row in ledger[1]] == [0, 1]
    assert ledger[1][0] == ledger[0][0]
    train = plans.read_train(spark, paths)
    expected = op.split_keyed(op.clean_rows(sources.read_flat(spark, flat_path))).where("is_train")
    assert train.count() == ledger[1][1]["total_train"] == expected.count()


def test_step_stream_over_the_streamed_table(spark, tmp_path):
    paths = plans.StatePaths(str(tmp_path / "state"))
    inbox = {"path": f"{tmp_path}/inbox"}
    sources.publish(samplefeed.messages(spark, SMALL), "parquet", inbox)
    streaming.run_flat_stream(spark, paths.flat, paths.checkpoint("flat"), "parquet", inbox)
    streaming.start_step_stream(spark, paths, START, trainer=fixed).awaitTermination(120)
    [batch] = plans.read_ledger(spark, paths).collect()
    assert batch["n_rows"] == sources.read_flat(spark, paths.flat).count()


def test_repeated_run_stops_after_the_given_steps(spark, paths):
    plans.run_every(spark, paths, seconds=0, steps=2, initial=START, trainer=fixed)
    assert plans.read_ledger(spark, paths).count() == 1


def test_stream_restart_and_several_micro_batches(spark, tmp_path):
    inbox = {"path": f"{tmp_path}/inbox", "maxFilesPerTrigger": "3"}
    messages = samplefeed.messages(spark, SMALL).repartition(8)
    table, checkpoint = f"{tmp_path}/flat", f"{tmp_path}/checkpoint"
    expected = 0
    for added, batches in ((6000, 3), (0, 0), (6000, 3)):
        if added:
            sources.publish(messages, "parquet", inbox)
        query = streaming.run_flat_stream(spark, table, checkpoint, "parquet", inbox, timeout=120)
        expected += added
        assert not query.isActive
        assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == batches
        assert sources.read_flat(spark, table).count() == expected


def tiny(spark, *days, name="n"):
    rows = [(f"{name}{k}", day, float(k), 1.0, 3.0, 4.0, 0.0) for k, day in enumerate(days)]
    return spark.createDataFrame(rows, FLAT_SCHEMA).coalesce(1)


def test_rows_behind_the_cursor_are_set_aside_and_counted(spark, tmp_path):
    paths = plans.StatePaths(str(tmp_path / "state"))
    seen = []
    for days in (["2023-12-31", "2024-01-05"], ["2024-01-04", "2024-01-09", "2023-12-30"], ["2024-01-09"], [], ["2024-01-10"]):
        if days:
            sources.write_flat(tiny(spark, *days), paths.flat)
        row = plans.run_available(spark, paths, initial=date(2023, 12, 31), trainer=fixed)
        seen.append(row and (row["n_rows"], row["n_late"], row["cursor_date"].day))
    # Rows dated before the first cursor are neither used nor late.
    assert seen == [(1, 0, 5), (2, 1, 9), (1, 1, 9), None, (1, 0, 10)]
    assert sorted(r["approach_date"].day for r in read_rows(spark, paths, "late").collect()) == [4, 9]
    assert plans.read_train(spark, paths).count() + plans.read_scored(spark, paths).count() == 3
    files = sources.flat_files(spark, paths.flat)
    known = read_sources(spark, paths).select("source")
    assert known.count() == files.count() and files.select("source").exceptAll(known).isEmpty()


def test_late_rows_of_a_failed_step_are_counted_by_its_retry(spark, tmp_path):
    paths = plans.StatePaths(str(tmp_path / "state"))
    sources.write_flat(tiny(spark, *["2024-01-05"] * 9), paths.flat)
    plans.run_available(spark, paths, initial=START, trainer=fixed)
    sources.write_flat(tiny(spark, *["2024-01-03"] * 2, *["2024-01-07"] * 9), paths.flat)

    def broken(train):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        plans.run_available(spark, paths, trainer=broken)
    row = plans.run_available(spark, paths, trainer=fixed)
    assert (row["n_rows"], row["n_late"]) == (11, 2)
    assert plans.run_available(spark, paths, trainer=fixed) is None


def test_the_first_cursor_lasts(spark, tmp_path):
    """Yesterday is taken once: what is dated after the first start is used, however late the first data land."""
    paths = plans.StatePaths(str(tmp_path / "state"))
    assert plans.run_available(spark, paths, trainer=fixed) is None  # no table yet
    today = spark.range(1).select(F.current_date()).first()[0]
    assert read_start(spark, paths) == today - timedelta(1)
    # As if the job had started ten days ago: the clock has moved since.
    spark.createDataFrame([(today - timedelta(11),)], "start DATE").coalesce(1).write.mode("overwrite").parquet(paths.start)
    days = [str(today - timedelta(k)) for k in (12, 11, 2)]
    sources.write_flat(tiny(spark, *days), paths.flat)
    row = plans.run_available(spark, paths, trainer=fixed)
    assert (row["n_rows"], row["first_date"]) == (1, today - timedelta(2))
    assert plans.run_available(spark, paths, initial=START, trainer=fixed) is None


def raw_batch(paths, n):
    """A finished batch as small files, written without Spark."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pathlib import Path

    def write(folder, **columns):
        Path(folder).mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table(columns), f"{folder}/part-0.parquet")

    day = pa.array([date(2024, 1, 5)] * 3)
    for part in ("train", "late"):
        write(f"{of_batch(paths.rows, n)}/part={part}", name=[f"{n}-{k}" for k in range(3)], approach_date=day)
    write(of_batch(paths.scored, n), name=[f"{n}-s"], prediction=[1.0])
    write(of_batch(paths.sources, n), source=[f"file{n}"])
    write(of_batch(paths.ledger, n), n_rows=[6], n_train=[3], total_train=[3 * n + 3], cursor_date=pa.array([date(2024, 1, 5)]))
    (Path(of_batch(paths.ledger, n)) / "_SUCCESS").touch()


def test_levels_bound_rewrites_and_folders(spark, tmp_path, monkeypatch):
    import math

    from perigee.plans import state as module

    monkeypatch.setattr(module, "MERGE_EVERY", 4)
    paths, n, written = plans.StatePaths(str(tmp_path / "state")), 70, 0
    write_run = module._write_run

    def counting(spark, paths, level, runs, batches):
        nonlocal written
        run = write_run(spark, paths, level, runs, batches)
        written += run.last - run.first + 1
        return run

    monkeypatch.setattr(module, "_write_run", counting)
    for k in range(n):
        raw_batch(paths, k)
        if k % 4 == 3:
            module.merge_levels(spark, paths)
            runs, alone = module.live(spark, paths)
            assert len(alone) < 4 and len(runs) <= 3 * math.ceil(math.log(k + 2, 4))
            batches = [x for r in runs for x in range(r.first, r.last + 1)] + alone
            assert batches == list(range(k + 1))
    assert written <= n * math.log(n, 4)
    ledger = plans.read_ledger(spark, paths)
    assert sorted(r["batch_id"] for r in ledger.collect()) == list(range(n))
    names = {(r["batch_id"], r["name"]) for r in plans.read_train(spark, paths).collect()}
    assert names == {(b, f"{b}-{k}") for b in range(n) for k in range(3)}
    assert plans.read_scored(spark, paths).count() == read_sources(spark, paths).count() == n
    assert read_rows(spark, paths, "late").count() == 3 * n


@pytest.mark.parametrize("broken", ["write", "delete", "delete_later"])
def test_a_merge_cut_short_changes_nothing(spark, tmp_path, monkeypatch, broken):
    from perigee.plans import state as module

    monkeypatch.setattr(module, "MERGE_EVERY", 3)
    paths = plans.StatePaths(str(tmp_path / "state"))
    for k in range(8):
        raw_batch(paths, k)
        if k % 3 == 2:
            module.merge_levels(spark, paths)
    raw_batch(paths, 8)
    before = state(spark, paths)
    calls = 0

    def lost(*args):
        nonlocal calls
        calls += 1
        if broken != "delete_later" or calls > 4:
            raise RuntimeError("lost")
        return delete(*args)

    delete = module._delete
    with monkeypatch.context() as patch:
        if broken == "write":
            # The last table, the run's ledger, is never written.
            read = module._read_batches
            patch.setattr(module, "_read_batches", lambda *a: lost() if a[2] == "ledger" and len(a) > 4 else read(*a))
        else:
            patch.setattr(module, "_delete", lost)
        with pytest.raises(RuntimeError):
            module.merge_levels(spark, paths)
    assert state(spark, paths) == before
    module.merge_levels(spark, paths)
    assert state(spark, paths) == before
    raw_batch(paths, 9)
    assert [r["batch_id"] for r in state(spark, paths)[0]] == list(range(10))
