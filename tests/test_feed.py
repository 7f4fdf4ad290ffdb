"""Windows, envelopes and messages."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

import samplefeed
from perigee import operators as op
from perigee import sources

SMALL = "/root/testdata/sf0.001"


def test_windows_touch_without_overlap(spark):
    rows = sources.feed_windows(spark, date(2024, 2, 27), date(2024, 3, 3)).collect()
    assert [tuple(row) for row in rows] == [
        (date(2024, 2, 27), date(2024, 2, 28)),
        (date(2024, 2, 29), date(2024, 3, 1)),
        (date(2024, 3, 2), date(2024, 3, 3)),
    ]


def test_windows_of_one_day_and_of_nothing(spark):
    one = sources.feed_windows(spark, date(2024, 1, 1), date(2024, 1, 1)).collect()
    assert [tuple(row) for row in one] == [(date(2024, 1, 1), date(2024, 1, 2))]
    assert sources.feed_windows(spark, date(2024, 1, 2), date(2024, 1, 1)).isEmpty()
    week = sources.feed_windows(spark, date(2024, 1, 1), date(2024, 1, 8), step_days=7).collect()
    assert [row["window_end"] for row in week] == [date(2024, 1, 7), date(2024, 1, 14)]


def test_pending_windows(spark):
    windows = sources.feed_windows(spark, date(2024, 1, 1), date(2024, 1, 6))
    done = spark.createDataFrame([(date(2024, 1, 3),), (date(2024, 1, 3),)], "window_start DATE")
    pending = sources.pending_windows(windows, done).orderBy("window_start").collect()
    assert [row["window_start"] for row in pending] == [date(2024, 1, 1), date(2024, 1, 5)]


ENVELOPES = [
    '{"element_count":3,"near_earth_objects":{"2024-01-05":[{"name":"a","extra":{"x":[1,2]}},{"name":"b"}],'
    '"2024-01-06":[]}}',
    '{"near_earth_objects":{"2024-01-05":[{"name":"c"}],"no date":[{"name":"d"}],"2024-01-07":null}}',
    '{"error":"quota"}',
    "broken",
]


def envelope_rows(spark):
    return spark.createDataFrame([(text,) for text in ENVELOPES], "value STRING")


def test_fan_out_keeps_whole_objects(spark):
    rows = sources.explode_envelope(envelope_rows(spark)).collect()
    assert sorted((row["date"], row["value"]) for row in rows) == [
        ("2024-01-05", '{"name":"a","extra":{"x":[1,2]}}'),
        ("2024-01-05", '{"name":"b"}'),
        ("2024-01-05", '{"name":"c"}'),
        ("no date", '{"name":"d"}'),
    ]


def test_broken_envelopes_and_empty_elements_are_rejects(spark):
    cut = '{"near_earth_objects":{"2024-01-05":[{"name":"a"},{"name":"b"},{"name":"c"}],"2024-01-06":[{"na'
    nulls = '{"near_earth_objects":{"2024-01-05":[null,{"name":"e"},null]}}'
    rows = spark.createDataFrame([(text,) for text in [*ENVELOPES, cut, nulls, None]], "value STRING")
    found = sorted(map(tuple, sources.envelope_rejects(rows).collect()), key=str)
    assert found == sorted(
        [("undecodable", None, ENVELOPES[2]), ("undecodable", None, "broken"), ("undecodable", None, cut),
         ("undecodable", None, None), *[("empty_element", "2024-01-05", None)] * 2], key=str
    )
    names = [row["value"] for row in sources.explode_envelope(rows).collect()]
    assert len(names) == 5 and None not in names and '{"name":"e"}' in names


def test_date_counts_with_empty_lists(spark):
    rows = sources.date_counts(envelope_rows(spark)).orderBy("close_approach_date").collect()
    assert [tuple(row) for row in rows] == [
        (None, 1, 1),
        (date(2024, 1, 5), 3, 4),
        (date(2024, 1, 6), 0, 4),
        (date(2024, 1, 7), 0, 4),
    ]


def test_text_envelopes_are_whole_files(spark, tmp_path):
    for i, text in enumerate(ENVELOPES):
        (tmp_path / f"{i}.json").write_text(text.replace(",", ",\n"))
    rows = sources.explode_envelope(sources.read_envelopes(spark, str(tmp_path)))
    assert rows.count() == 4


def test_encode_keeps_every_field(spark):
    rows = spark.createDataFrame([(1, "a", 0.5, None), (2, None, None, [1])], "k INT, s STRING, d DOUBLE, l ARRAY<INT>")
    encoded = sources.encode(rows, keep=["k"])
    assert dict(encoded.dtypes) == {"k": "int", "value": "binary"}
    assert {row["k"]: bytes(row["value"]) for row in encoded.collect()} == {1: b'{"s":"a","d":0.5}', 2: b'{"l":[1]}'}


def test_publish_appends(spark, tmp_path):
    for _ in range(2):
        sources.publish(samplefeed.messages(spark, SMALL), "parquet", {"path": f"{tmp_path}/m"})
    assert sources.read_messages(spark, "parquet", {"path": f"{tmp_path}/m"}).count() == 12000


def test_topics_go_to_the_connector(spark):
    options = {"kafka.bootstrap.servers": "broker:9092", "subscribe": "objects"}
    for call in (sources.read_messages, sources.message_stream):
        # No connector is installed here: what matters is that the format reaches Spark.
        with pytest.raises(Exception, match="(?i)kafka"):
            call(spark, "kafka", options)


def test_envelopes_are_bounded_whatever_the_dates(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(samplefeed.build, "PAGE_BITS", 6)
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    one_day = lineitem.withColumn("l_shipdate", F.lit("1996-03-04").cast("timestamp_ntz"))
    one_day.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = samplefeed.envelopes(spark, str(tmp_path))
    sizes = found.select(F.from_json("value", "near_earth_objects MAP<STRING, ARRAY<STRING>>").alias("e")).select(
        F.aggregate(F.map_values("e.near_earth_objects"), F.lit(0), lambda n, xs: n + F.size(xs)).alias("n")
    )
    assert sizes.agg(F.max("n")).first()[0] <= 64
    expected = lineitem.count()
    assert sizes.agg(F.sum("n")).first()[0] == expected


def test_flat_table_prunes_months_and_pushes_days(spark, tmp_path):
    sources.write_flat(op.flatten(samplefeed.messages(spark, SMALL)), f"{tmp_path}/flat")
    flat = sources.read_flat(spark, f"{tmp_path}/flat")
    assert flat.count() == 6000
    plan = op.newer_than(flat, date(2000, 5, 17))._jdf.queryExecution().executedPlan().toString()
    assert "approach_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThan(approach_date,2000-05-17)" in plan
    newer = op.newer_than(flat, date(2000, 5, 17)).count()
    late = op.late_rows(flat, date(2000, 5, 17)).count()
    assert newer + late == flat.where("approach_date IS NOT NULL").count()
    between = op.newer_than(flat, date(2000, 5, 17), date(2000, 7, 2))
    assert between.count() == flat.where("approach_date BETWEEN '2000-05-18' AND '2000-07-02'").count() > 0


def test_named_table_is_visible_to_sql(spark, tmp_path):
    sources.write_flat(op.flatten(samplefeed.messages(spark, SMALL)), f"{tmp_path}/flat")
    flat = sources.register_flat(spark, f"{tmp_path}/flat")
    found = spark.sql(
        "SELECT * FROM streaming_data WHERE CAST(approach_date AS DATE) > CAST('2000-01-01' AS DATE)"
    )
    assert found.count() == op.newer_than(flat, date(2000, 1, 1)).count()


def test_rows_to_score(spark):
    rows = spark.createDataFrame([("1", "2.5", "n/a", 7)], "estimated_diameter_km_min STRING, "
        "estimated_diameter_km_max STRING, relative_velocity_km_s STRING, miss_distance_km INT")
    assert sources.read_to_score(rows).first().asDict() == {
        "estimated_diameter_km_min": 1.0,
        "estimated_diameter_km_max": 2.5,
        "miss_distance_km": 7.0,
        "relative_velocity_km_s": None,
    }


LANDED = [
    '{"near_earth_objects": {"2024-01-05": [{"name": "a"}, null, {"name": "b"}], "2024-01-06": []}}',
    '{"near_earth_objects": {"2024-01-07": [{"name": "c"}], "2024-01-08": null}}',
    "{cut",
    '{"other": 1}',
]


def land(folder, *envelopes, of="x"):
    folder.mkdir(exist_ok=True)
    for k, text in enumerate(envelopes):
        (folder / f"{of}{k}.json").write_text(text)


def fan_out(spark, tmp_path):
    from perigee import streaming

    query = streaming.start_fan_out(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    out = str(tmp_path / "out")
    names = sorted(json.loads(r["value"])["name"] for r in streaming.read_fanned(spark, out).collect())
    rejects = streaming.read_fanned(spark, out, streaming.REJECT).collect()
    return names, sorted(((r["reason"], r["date"], r["value"]) for r in rejects), key=str), query


def test_streamed_fan_out_reads_each_envelope_once(spark, tmp_path):
    land(tmp_path / "in", *LANDED)
    names, rejects, _ = fan_out(spark, tmp_path)
    broken = [("undecodable", None, t) for t in LANDED[2:]]
    assert names == ["a", "b", "c"]
    assert rejects == sorted([("empty_element", "2024-01-05", None), *broken], key=str)
    # The same rows as the batch functions give.
    table = spark.createDataFrame([(t,) for t in LANDED], "value string")
    assert sorted(map(tuple, sources.envelope_rejects(table).collect()), key=str) == rejects
    # A second run opens the new file alone; an envelope that lands again counts once.
    land(tmp_path / "in", '{"near_earth_objects": {"2024-01-09": [{"name": "d"}]}}', LANDED[0], of="y")
    names, again, query = fan_out(spark, tmp_path)
    assert names == ["a", "b", "c", "d"] and again == rejects
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert fan_out(spark, tmp_path)[0] == names


@pytest.mark.parametrize("lost", [["check/commits/0"], ["check/commits/0", "out/_spark_metadata/0"]])
def test_fan_out_that_failed_publishes_each_object_once(spark, tmp_path, lost):
    """As after a crash behind the sink's log, and one before it, which leaves files of no batch."""
    land(tmp_path / "in", *LANDED)
    before = fan_out(spark, tmp_path)[:2]
    for name in lost:
        (tmp_path / name).unlink()
        (tmp_path / name).with_name(".0.crc").unlink(missing_ok=True)
    assert fan_out(spark, tmp_path)[:2] == before


def test_streamed_messages_reach_the_flat_table(spark, tmp_path):
    from perigee import streaming

    land(tmp_path / "in", *LANDED)
    fan_out(spark, tmp_path)
    messages = streaming.read_fanned(spark, str(tmp_path / "out"), stream=True).select("value")
    query = streaming.write_flat_stream(op.flatten(messages), str(tmp_path / "flat"), str(tmp_path / "c2"), streaming.AVAILABLE_NOW)
    query.awaitTermination(120)
    assert sorted(r["name"] for r in sources.read_flat(spark, str(tmp_path / "flat")).collect()) == ["a", "b", "c"]


def test_repeated_messages_are_dropped_by_key(spark, tmp_path):
    from perigee import streaming

    rows = [("k1", "2024-01-05 10:00:00"), ("k2", "2024-01-05 10:01:00"), ("k1", "2024-01-05 10:02:00")]
    schema = "key string, timestamp timestamp"
    path = str(tmp_path / "messages")
    table = spark.createDataFrame(rows, "key string, t string").selectExpr("key", "CAST(t AS TIMESTAMP) AS timestamp")
    query_rows = []
    for _ in range(2):  # the second time a retry sends all of them again
        table.coalesce(1).write.mode("append").parquet(path)
        stream = streaming.once(spark.readStream.schema(schema).parquet(path))
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "once"))
        query = query.option("checkpointLocation", str(tmp_path / "c3")).trigger(**streaming.AVAILABLE_NOW).start()
        query.awaitTermination(120)
        query_rows.append(sorted(r["key"] for r in spark.read.schema(schema).parquet(str(tmp_path / "once")).collect()))
    assert query_rows == [["k1", "k2"]] * 2


def step(spark, tmp_path, **settings):
    from perigee import plans

    return plans.fan_out_step(
        spark, str(tmp_path / "in"), str(tmp_path / "done"), options={"path": str(tmp_path / "out")}, rejects=str(tmp_path / "bad"), **settings
    )


def published(spark, tmp_path):
    messages = sources.read_messages(spark, options={"path": str(tmp_path / "out")}).collect()
    rejects = spark.read.parquet(str(tmp_path / "bad")).select("reason", "date", "value").collect()
    return sorted(json.loads(r["value"])["name"] for r in messages), sorted(map(tuple, rejects), key=str)


ALL_REJECTS = sorted([("empty_element", "2024-01-05", None), *(("undecodable", None, t) for t in LANDED[2:])], key=str)


def test_a_batch_step_opens_new_files_alone(spark, tmp_path, monkeypatch):
    from perigee.plans import publishing

    land(tmp_path / "in", *LANDED)
    assert step(spark, tmp_path) == 0 and published(spark, tmp_path) == (["a", "b", "c"], ALL_REJECTS)
    assert step(spark, tmp_path) is None
    # Equal envelopes count once, across steps and within one; those opened before are not opened again.
    land(tmp_path / "in", '{"near_earth_objects": {"2024-01-09": [{"name": "d"}]}}', LANDED[0], LANDED[2], of="y")
    land(tmp_path / "in", '{"near_earth_objects": {"2024-01-09": [{"name": "d"}]}}', of="z")
    opened = []
    rows_of_files = publishing.rows_of_files
    monkeypatch.setattr(publishing, "rows_of_files", lambda *a: opened.append(rows_of_files(*a)) or opened[-1])
    assert step(spark, tmp_path) == 1 and opened[0].count() == 4
    assert published(spark, tmp_path) == (["a", "b", "c", "d"], ALL_REJECTS)
    # The staged copies are gone.
    assert not list((tmp_path / "done").glob("*/envelopes")) and step(spark, tmp_path) is None


@pytest.mark.parametrize("at", ["stage", "before messages", "messages written", "before rejects", "before listing", "before cleaning"])
def test_a_batch_step_that_failed_publishes_each_object_once(spark, tmp_path, monkeypatch, at):
    from perigee.plans import publishing

    class Crash(Exception):
        pass

    def crash(*_):
        raise Crash

    land(tmp_path / "in", *LANDED)
    visible, delete, publish = publishing._visible_at_once, publishing._delete, publishing.publish
    calls = []

    def nth(spark, path, name, write):
        calls.append(path)
        if (at, len(calls)) in (("before messages", 1), ("before rejects", 2)):
            raise Crash
        visible(spark, path, name, write)
        if (at, len(calls)) == ("before listing", 2):
            raise Crash

    with monkeypatch.context() as broken:
        if at == "stage":
            broken.setattr(publishing, "unpublished", crash)
        elif at == "messages written":
            broken.setattr(publishing, "publish", lambda *a: crash(publish(*a)))
        elif at == "before cleaning":
            broken.setattr(publishing, "_delete", lambda s, p: crash() if p.endswith("/envelopes") else delete(s, p))
        else:
            broken.setattr(publishing, "_visible_at_once", nth)
        with pytest.raises(Crash):
            step(spark, tmp_path)
    # What lands in between is left to the step after.
    land(tmp_path / "in", '{"near_earth_objects": {"2024-01-09": [{"name": "d"}]}}', of="y")
    steps = [step(spark, tmp_path) for _ in range(3)]
    assert steps[-1] is None and published(spark, tmp_path) == (["a", "b", "c", "d"], ALL_REJECTS)
    assert not list((tmp_path / "done").glob("*/envelopes"))


def test_two_fan_outs_share_a_directory_that_streams_read(spark, tmp_path):
    from perigee import plans, streaming

    land(tmp_path / "in", LANDED[0])
    land(tmp_path / "in2", LANDED[1])
    for folder in ("in", "in2"):
        plans.fan_out_step(spark, str(tmp_path / folder), str(tmp_path / f"done-{folder}"), options={"path": str(tmp_path / "out")})
    flat, check = str(tmp_path / "flat"), str(tmp_path / "check")
    for want in (["a", "b", "c"], ["a", "b", "c", "d"]):
        streaming.run_flat_stream(spark, flat, check, options={"path": str(tmp_path / "out")}, timeout=120)
        assert sorted(r["name"] for r in sources.read_flat(spark, flat).collect()) == want
        land(tmp_path / "in", '{"near_earth_objects": {"2024-01-09": [{"name": "d"}]}}', of="y")
        plans.fan_out_step(spark, str(tmp_path / "in"), str(tmp_path / "done-in"), options={"path": str(tmp_path / "out")})


def test_keys_go_to_a_topic(spark, tmp_path):
    from pyspark.errors import AnalysisException

    land(tmp_path / "in", *LANDED)
    from perigee import plans

    with pytest.raises(AnalysisException, match="kafka"):
        plans.fan_out_step(spark, str(tmp_path / "in"), str(tmp_path / "done"), fmt="kafka", options={"topic": "t"})
    # The staged envelopes wait for the retry.
    assert step(spark, tmp_path) == 0
    assert spark.read.parquet(str(tmp_path / "out")).select("key").distinct().count() == 3
