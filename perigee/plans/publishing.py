"""One step of the batch fan-out: new envelope files -> messages and rejects, each published once.

    done/  step=N/files       the envelope files that the step opened
           step=N/envelopes   its new envelopes, until they are published
           step=N/digests     their digests, written last: the step is done

A step whose envelopes are staged is finished by the next run before anything new is read, so a retry publishes the
same rows under the same name. In a directory they are a folder run=<name> that a rename makes visible at once, and a
retry that finds it leaves it; where a rename is no single act (object stores), use the stream instead. On a topic,
where a retry sends them again, messages carry a key that `streaming.once` drops repeats by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from perigee.plans.state import _complete, _delete, _folder, _read_or_empty, _values
from perigee.schema import MAX_FILE_ROWS
from perigee.sources.envelopes import fan_out, read_envelopes, unpublished
from perigee.sources.messages import FILE_FORMATS, publish
from perigee.sources.tables import landed_files, rows_of_files

_FILES = "source STRING, modified TIMESTAMP"


def fan_out_step(
    spark: SparkSession,
    envelopes: str,
    done: str,
    envelope_fmt: str = "text",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    rejects: str | None = None,
) -> int | None:
    """Publishes what the envelopes hold that no step published, and returns the step's number; None without new files.

    Envelopes come as files: those that an earlier step opened are not opened again, whatever they hold now, and an
    envelope equal to a published one is not published. A null or broken envelope is a reject.
    """
    listed = [n for n in map(int, _values(spark, done, "step")) if _complete(spark, f"{done}/step={n}/digests")]
    number = max(listed, default=-1) + 1
    step = f"{done}/step={number}"
    if listed:  # the copy of a step that ended between its last two acts
        _delete(spark, f"{done}/step={number - 1}/envelopes")
    if not _complete(spark, f"{step}/envelopes") and not _stage(spark, envelopes, done, step, envelope_fmt):
        return None
    staged = spark.read.schema("digest STRING, value STRING").parquet(f"{step}/envelopes")
    rows = fan_out(staged)
    system, named = _folder(spark, done)
    name = f"{hashlib.sha256(system.makeQualified(named).toString().encode()).hexdigest()[:12]}-{number}"
    messages = rows.where("reason IS NULL").select("key", "value")
    settings = dict(options or {})
    if fmt in FILE_FORMATS:
        path = settings.pop("path")
        _visible_at_once(spark, path, name, lambda folder: publish(messages, fmt, {**settings, "path": folder}))
    else:
        publish(messages, fmt, settings)
    if rejects is not None:
        broken = rows.where("reason IS NOT NULL").select("reason", "date", "value")
        _visible_at_once(spark, rejects, name, broken.write.option("maxRecordsPerFile", MAX_FILE_ROWS).parquet)
    staged.select("digest").write.mode("overwrite").parquet(f"{step}/digests")
    _delete(spark, f"{step}/envelopes")
    return number


def _stage(spark: SparkSession, envelopes: str, done: str, step: str, fmt: str) -> bool:
    """Writes the step's files and envelopes; False without new files."""
    # A run that failed while it staged left files but no envelopes: both are written anew, by all that is listed.
    _delete(spark, step)
    known = _read_or_empty(spark, f"{done}/*/files", _FILES)
    new = landed_files(spark, envelopes).join(known.select("source"), "source", "left_anti")
    new.hint("rebalance").write.mode("overwrite").parquet(f"{step}/files")
    new = spark.read.schema(_FILES).parquet(f"{step}/files")
    since = new.agg(F.min("modified")).first()[0]
    if since is None:
        _delete(spark, step)
        return False
    found = rows_of_files(read_envelopes(spark, envelopes, fmt), new, since)
    published = _read_or_empty(spark, f"{done}/*/digests", "digest STRING")
    unpublished(found, published).select("digest", "value").write.mode("overwrite").parquet(f"{step}/envelopes")
    return True


def _visible_at_once(spark: SparkSession, path: str, name: str, write) -> None:
    """Writes a folder under a hidden name and renames it; does nothing if it is there."""
    system, target = _folder(spark, f"{path}/run={name}")
    if system.exists(target):
        return
    attempt = f"{path}/_attempt-{name}"
    _delete(spark, attempt)
    write(attempt)
    if not system.rename(_folder(spark, attempt)[1], target):
        raise OSError(f"{attempt} could not be renamed to {target}")
