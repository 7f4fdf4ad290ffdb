"""The jobs behind spark-submit: `python -m perigee <job> ...` (each job is one function call).

The session is the submitted one; nothing is configured here.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from perigee import operators, plans, sources, streaming


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _endpoint(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--format", default="parquet", help="message format: parquet, text, kafka, ...; fanned: a table of stream-fan-out, to read")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="perigee")
    jobs = top.add_subparsers(dest="job", required=True)

    windows = jobs.add_parser("windows", help="write the request windows of a date span that have not landed")
    windows.add_argument("start", type=date.fromisoformat)
    windows.add_argument("stop", type=date.fromisoformat)
    windows.add_argument("path")
    windows.add_argument("--landed", metavar="ENVELOPES", help="envelopes landed so far")
    windows.add_argument("--envelope-format", default="text")

    fan_out = jobs.add_parser("fan-out", help="publish the objects of landed envelopes as messages, once")
    fan_out.add_argument("envelopes")
    fan_out.add_argument("done", help="folder of the files and envelopes fanned out before, kept by this job")
    fan_out.add_argument("--envelope-format", default="text")
    fan_out.add_argument("--rejects", help="table to which broken envelopes and empty list elements go")
    _endpoint(fan_out)

    fan_stream = jobs.add_parser("stream-fan-out", help="stream landed envelopes into a table of messages and rejects")
    fan_stream.add_argument("envelopes")
    fan_stream.add_argument("path")
    fan_stream.add_argument("checkpoint")
    fan_stream.add_argument("--envelope-format", default="text")
    fan_stream.add_argument("--live", action="store_true", help="keep running, one trigger every 30 seconds")

    stream = jobs.add_parser("stream", help="stream messages into the flat table")
    stream.add_argument("root")
    stream.add_argument("--live", action="store_true", help="keep running, one trigger every 30 seconds")
    _endpoint(stream)

    step = jobs.add_parser("step", help="train and score on rows newer than the cursor")
    step.add_argument("root")
    step.add_argument("--initial", type=date.fromisoformat, help="first cursor (default: yesterday)")
    step.add_argument("--every", type=float, metavar="SECONDS", help="repeat with this pause")
    step.add_argument("--steps", type=int, help="stop after this many repeats")
    step.add_argument("--cursor-from", choices=["batch", "test"], default="batch")
    step.add_argument("--look-back", type=int, metavar="BATCHES")

    score = jobs.add_parser("score", help="score a Parquet table of the four inputs with the latest model")
    score.add_argument("root")
    score.add_argument("rows")
    score.add_argument("path")

    export = jobs.add_parser("export", help="write the latest scored rows")
    export.add_argument("root")
    export.add_argument("path")
    which = export.add_mutually_exclusive_group()
    which.add_argument("--all", action="store_true", help="every batch, not only the latest")
    which.add_argument("--new", action="store_true", help="the batches that the target doesn't hold yet")

    summary = jobs.add_parser("summary", help="print the headline figures")
    summary.add_argument("root")
    summary.add_argument("--start", type=date.fromisoformat)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = plans.StatePaths(args.root) if "root" in args else None
    match args.job:
        case "windows":
            windows = sources.feed_windows(spark, args.start, args.stop)
            if args.landed is not None:
                landed = sources.envelope_dates(sources.read_envelopes(spark, args.landed, args.envelope_format))
                windows = sources.pending_windows(windows, landed.select(landed["date"].alias("window_start")))
            windows.write.mode("overwrite").parquet(args.path)
        case "fan-out":
            options = _options(args.option)
            plans.fan_out_step(spark, args.envelopes, args.done, args.envelope_format, args.format, options, args.rejects)
        case "stream-fan-out":
            trigger = streaming.LIVE if args.live else streaming.AVAILABLE_NOW
            streaming.start_fan_out(
                spark, args.envelopes, args.path, args.checkpoint, args.envelope_format, trigger
            ).awaitTermination()
        case "stream":
            trigger, options = streaming.LIVE if args.live else streaming.AVAILABLE_NOW, _options(args.option)
            if args.format == "fanned":
                messages = streaming.read_fanned(spark, options["path"], stream=True)
                flat = operators.flatten(messages.select("value"))
                streaming.write_flat_stream(flat, paths.flat, paths.checkpoint("flat"), trigger).awaitTermination()
                return
            streaming.run_flat_stream(spark, paths.flat, paths.checkpoint("flat"), args.format, options, trigger)
        case "step":
            settings = {"initial": args.initial, "cursor_from": args.cursor_from, "look_back": args.look_back}
            if args.every is None:
                plans.run_available(spark, paths, **settings)
            else:
                plans.run_every(spark, paths, args.every, args.steps, **settings)
        case "score":
            model = plans.read_model(plans.read_ledger(spark, paths))
            rows = sources.read_to_score(spark.read.parquet(args.rows))
            operators.score_table(rows, model).write.parquet(args.path)
        case "export":
            if args.new:
                operators.export_new(plans.read_scored(spark, paths), args.path)
                return
            operators.export_scored(plans.read_scored(spark, paths, latest_only=not args.all), args.path)
        case "summary":
            plans.run_summary(plans.read_ledger(spark, paths), args.start).show(truncate=False)


if __name__ == "__main__":
    run(SparkSession.builder.appName("perigee").getOrCreate(), parser().parse_args())
