"""The command-line jobs, one after the other over one state directory."""

from perigee import plans
from perigee.__main__ import parser, run
from samplefeed import broken_envelopes, envelopes, form_rows

SMALL = "/root/testdata/sf0.001"


def test_all_jobs(spark, tmp_path, capsys):
    def job(*words):
        run(spark, parser().parse_args(list(words)))

    root, inbox = f"{tmp_path}/state", f"path={tmp_path}/messages"
    for _ in range(2):
        job("windows", "2024-01-01", "2024-01-10", f"{tmp_path}/windows")
        assert spark.read.parquet(f"{tmp_path}/windows").count() == 5
    landed = f"{tmp_path}/envelopes"
    envelopes(spark, SMALL).write.parquet(landed)
    fan_out = ("fan-out", landed, f"{tmp_path}/done", "--envelope-format", "parquet", "--option", inbox)
    rejects = f"{tmp_path}/rejects"
    for added in (0, 0, 7):
        if added:
            broken = broken_envelopes(spark, SMALL).where("length(value) % 2 = 0").limit(added)
            broken.write.mode("append").parquet(landed)
        before = 0 if not (tmp_path / "messages").exists() else spark.read.parquet(f"{tmp_path}/messages").count()
        job(*fan_out, "--rejects", rejects)
        after = spark.read.parquet(f"{tmp_path}/messages").count()
        assert (before == 0 and after == 6000) or (added == 0 and after == before) or 0 <= after - before <= 2 * added
    pending = f"{tmp_path}/pending"
    for _ in range(2):
        job("windows", "1995-01-01", "2030-12-31", pending, "--landed", landed, "--envelope-format", "parquet")
        starts = spark.read.parquet(pending)
        assert 0 < starts.count() < 6574 and starts.where("window_start = '1996-03-03'").isEmpty()
    job("stream", root, "--option", inbox)
    job("step", root, "--initial", "1990-01-01")
    job("step", root, "--every", "0", "--steps", "1")
    paths = plans.StatePaths(root)
    [batch] = plans.read_ledger(spark, paths).collect()
    assert batch["accuracy"] > 0.9
    form_rows(spark, SMALL).write.parquet(f"{tmp_path}/form")
    job("score", root, f"{tmp_path}/form", f"{tmp_path}/answers")
    assert spark.read.parquet(f"{tmp_path}/answers").where("predicted_value = 'Hazardous'").count() > 0
    job("export", root, f"{tmp_path}/export")
    assert spark.read.parquet(f"{tmp_path}/export").count() == batch["n_test"]
    capsys.readouterr()
    job("summary", root)
    assert str(batch["total_train"]) in capsys.readouterr().out


def test_streamed_jobs(spark, tmp_path):
    """The fan-out as a stream, and its messages into the flat table; a second round adds nothing."""
    def job(*words):
        run(spark, parser().parse_args(list(words)))

    landed, fanned, root = f"{tmp_path}/envelopes", f"{tmp_path}/fanned", f"{tmp_path}/state"
    envelopes(spark, SMALL).write.parquet(landed)
    broken_envelopes(spark, SMALL).where("length(value) % 2 = 0").limit(7).write.mode("append").parquet(landed)
    counts = []
    for _ in range(2):
        job("stream-fan-out", landed, fanned, f"{tmp_path}/checkpoint", "--envelope-format", "parquet")
        job("stream", root, "--format", "fanned", "--option", f"path={fanned}")
        counts.append(spark.read.parquet(plans.StatePaths(root).flat).count())
    messages = spark.read.parquet(fanned).where("kind = 'message'").count()
    assert counts == [messages] * 2 and 6000 <= messages <= 6014
