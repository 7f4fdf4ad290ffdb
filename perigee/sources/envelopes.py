"""Feed envelopes: one JSON document per request window, a map of date -> list of objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perigee.functions import to_day
from perigee.schema import COUNT_COLUMN, ENVELOPE_COUNT_SCHEMA, ENVELOPE_FIELD, ENVELOPE_SCHEMA


def read_envelopes(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """Landed envelopes as (value): whole text files, one envelope each, or a table with a value column."""
    if fmt == "text":
        return spark.read.text(path, wholetext=True)
    return spark.read.format(fmt).schema("value STRING").load(path)


def explode_envelope(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """One row (date, value) per object, value being the whole object as JSON text.

    Nothing is aggregated or moved. A date with no objects gives no rows; `envelope_rejects` has the
    envelopes and list elements that give none because they are broken.
    """
    return (
        envelopes.select(F.from_json(F.col(value).cast("string"), ENVELOPE_SCHEMA).alias("envelope"))
        .select(F.explode(f"envelope.{ENVELOPE_FIELD}").alias("date", "objects"))
        .select("date", F.explode("objects").alias("value"))
        .where("value IS NOT NULL")
    )


def envelope_rejects(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """One row (reason, date, value) for what can't be fanned out: an `undecodable` envelope (cut, no JSON, or
    without its map) with its text, and each `empty_element` (null) of a list with the date it is listed under."""
    text = F.col(value).cast("string")
    decoded = envelopes.select(text.alias("value"), F.from_json(text, ENVELOPE_SCHEMA)[ENVELOPE_FIELD].alias("feed"))
    # An undecodable envelope is one row; a decoded one has a row for each null element.
    nulls = F.flatten(
        F.transform(
            F.map_entries("feed"),
            lambda e: F.transform(F.filter(e["value"], lambda x: x.isNull()), lambda _: e["key"]),
        )
    )
    found = F.when(
        F.col("feed").isNull(),
        F.array(F.struct(F.lit("undecodable").alias("reason"), F.lit(None).cast("string").alias("date"), "value")),
    ).otherwise(
        F.transform(
            nulls,
            lambda key: F.struct(
                F.lit("empty_element").alias("reason"), key.alias("date"), F.lit(None).cast("string").alias("value")
            ),
        )
    )
    return decoded.select(F.inline(found))


def fan_out(envelopes: DataFrame, value: str = "value", digest: str = "digest") -> DataFrame:
    """Objects and rejects in one pass: rows (key, reason, date, value), of which those without a reason are objects.

    The same rows as those of explode_envelope and envelope_rejects together; key is the digest and the row's number.
    """
    text = F.col(value).cast("string")
    # A generator, lest the decoded map is decoded again for each use.
    decoded = envelopes.select(digest, text.alias("text"), F.explode(F.array(F.from_json(text, ENVELOPE_SCHEMA))).alias("e"))
    feed = F.col(f"e.{ENVELOPE_FIELD}")
    none = F.lit(None).cast("string")
    broken = F.array(F.struct(F.lit("undecodable").alias("reason"), none.alias("date"), F.col("text").alias("value")))
    listed = F.transform(
        F.map_entries(feed),
        lambda e: F.transform(
            e["value"],
            lambda x: F.struct(F.when(x.isNull(), "empty_element").alias("reason"), e["key"].alias("date"), x.alias("value")),
        ),
    )
    # A date without a list has no objects.
    objects = F.flatten(F.filter(listed, lambda rows: rows.isNotNull()))
    rows = decoded.select(digest, F.posexplode(F.when(feed.isNull(), broken).otherwise(objects)).alias("at", "row"))
    return rows.select(F.concat_ws("-", digest, "at").alias("key"), "row.reason", "row.date", "row.value")


def unpublished(envelopes: DataFrame, done: DataFrame, value: str = "value") -> DataFrame:
    """Envelopes whose digest is not among those fanned out before; equal envelopes are one."""
    keyed = envelopes.withColumn("digest", F.sha2(F.col(value).cast("binary"), 256))
    return keyed.join(done.select("digest"), "digest", "left_anti").dropDuplicates(["digest"])


def envelope_dates(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """One row (date DATE, objects BIGINT) per date of an envelope, 0 for an empty list.

    Lists are sized inside the envelope, their objects never built or exploded. Keys that are no
    date give a null date.
    """
    return (
        envelopes.select(
            F.from_json(F.col(value).cast("string"), ENVELOPE_COUNT_SCHEMA).alias("envelope")
        )
        .select(F.explode(f"envelope.{ENVELOPE_FIELD}").alias("key", "listed"))
        .select(
            to_day(F.col("key")).alias("date"),
            F.coalesce(F.size("listed"), F.lit(0)).cast("bigint").alias("objects"),
        )
    )


def date_counts(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """Objects per date with the running total over dates; a null date sorts first.

    Dates are summed first, so the ordered window sees one row per calendar day however many
    envelopes and objects there are.
    """
    per_date = (
        envelope_dates(envelopes, value)
        .groupBy(F.col("date").alias("close_approach_date"))
        .agg(F.sum("objects").alias(COUNT_COLUMN))
    )
    so_far = Window.orderBy("close_approach_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return per_date.withColumn("running", F.sum(COUNT_COLUMN).over(so_far))
