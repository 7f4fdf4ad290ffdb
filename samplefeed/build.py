"""Spark side of the sample feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.schema import ENVELOPE_FIELD
from perigee.sources import encode

COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]

# Consecutive rows of one input split whose objects may share an envelope, as a power of two: bounds
# an envelope whatever the keys and dates are.
PAGE_BITS = 14

# Rows that a task makes objects of at most, on average, and those that are worth a task of their own.
MOST_ROWS, FEW_ROWS = 500_000, 20_000


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*COLUMNS)


def _spread(df: DataFrame) -> DataFrame:
    """The rows dealt over tasks, whatever splits the file has (often one): the feed's only shuffle.

    By a hash of a row's position in the unshuffled scan, the same on every attempt, so that copies of a row part
    too. The number of tasks follows the count of rows, read from the file's footers: a task sized by the bytes of
    these narrow rows would make ten times as many bytes of messages, and few such tasks leave cores idle.
    """
    n_rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_tasks = max(1, -(-n_rows // MOST_ROWS), min(cores, -(-n_rows // FEW_ROWS)))
    return df.withColumn("place", F.monotonically_increasing_id()).repartition(n_tasks, "place").drop("place")


# Where a column of a row is taken from: F.col of a table's row, another function of a listed one.
Take = Callable[[str], Column]


def _every(n: int, of: Take = F.col) -> Column:
    return of("l_orderkey") % n == 0


def _day(of: Take = F.col) -> Column:
    return of("l_shipdate").cast("date")


def _diameter(of: Take = F.col) -> Column:
    return F.when(~_every(101, of), of("l_extendedprice") / 20000.0)


def _miss(of: Take = F.col) -> Column:
    return of("l_partkey") * 25.5 + of("l_quantity")


# Velocity texts that are no usable number, each on the orders whose key it divides; the first that fits.
BAD_VELOCITIES = {89: "n/a", 83: "NaN", 79: "Infinity", 73: "-Infinity", 71: "1e999"}


def _velocity_text(of: Take = F.col) -> Column:
    text = of("l_quantity").cast("string")
    for divisor, bad in reversed(BAD_VELOCITIES.items()):
        text = F.when(_every(divisor, of), bad).otherwise(text)
    return text


def _approach(day: Column, velocity: Column, miss: Column) -> Column:
    return F.struct(
        day.alias("close_approach_date"),
        F.struct(velocity.alias("kilometers_per_second")).alias("relative_velocity"),
        F.struct(miss.cast("string").alias("kilometers")).alias("miss_distance"),
    )


def _fields(of: Take = F.col) -> list[Column]:
    """The fields of an object in message order, `id` being one that no schema declares."""
    day = _day(of)
    loose = F.concat_ws("-", F.year(day), F.month(day), F.day(day))
    first = _approach(
        F.when(_every(61, of), loose).otherwise(day.cast("string")), _velocity_text(of), _miss(of)
    )
    second = _approach(
        F.date_add(day, of("l_linenumber") * 30).cast("string"),
        (of("l_quantity") + 1).cast("string"),
        _miss(of) * 2,
    )
    # Each approach is written down once, which keeps the generated code small.
    count = F.when(_every(53, of), 0).when(of("l_linenumber") % 2 == 0, 2).otherwise(1)
    tag = F.concat_ws("-", of("l_orderkey"), of("l_linenumber"))
    return [
        F.concat(F.lit("neo-"), tag).alias("name"),
        tag.alias("id"),
        F.when(~_every(97, of), (of("l_extendedprice") > 60000) != _every(23, of)).alias(
            "is_potentially_hazardous_asteroid"
        ),
        F.struct(
            F.struct(
                _diameter(of).alias("estimated_diameter_max"),
                (_diameter(of) / 2.236).alias("estimated_diameter_min"),
            ).alias("kilometers")
        ).alias("estimated_diameter"),
        F.slice(F.array(first, second), F.lit(1), count).alias("close_approach_data"),
    ]


def objects(lineitem: DataFrame) -> DataFrame:
    """Object columns in message order behind the order key; extra input columns stay first."""
    return lineitem.select(*(name for name in lineitem.columns if name not in COLUMNS), "l_orderkey", *_fields())


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value BINARY): one encoded object per lineitem."""
    encoded = encode(objects(_spread(_lineitem(spark, sf_dir))), keep=["l_orderkey"])
    value = F.col("value")
    return encoded.select(F.when(_every(211), F.substring(value, 1, 20)).otherwise(value).alias("value"))


def ship_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (start, stop): the date span of the feed."""
    dates = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_shipdate")
    return dates.agg(
        F.min("l_shipdate").cast("date").alias("start"), F.max("l_shipdate").cast("date").alias("stop")
    )


def window_start(day: Column) -> Column:
    """Two-day windows counted from 1995-01-01."""
    return F.date_sub(day, F.pmod(F.datediff(day, F.lit("1995-01-01").cast("date")), F.lit(2)))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value STRING): envelopes of one two-day window each, both dates always present, each object under the
    date of its row, even if its list of approaches is empty. A window has one envelope per page of input rows.

    Pages are numbered on the unshuffled scan, where row positions are the same on every attempt.
    """
    page = F.shiftright(F.monotonically_increasing_id(), PAGE_BITS)
    paged = _lineitem(spark, sf_dir).withColumn("page", page).withColumn("l_shipdate", _day())
    paged = paged.withColumn("start", window_start(_day()))
    # The table's own narrow rows move, once; the objects are made of them in their envelope.
    grouped = paged.repartition("page", "start").groupBy("page", "start").agg(
        F.collect_list(F.struct(*COLUMNS)).alias("entries")
    )

    def on(day: Column) -> Column:
        return F.transform(
            F.filter("entries", lambda row: _day(row.getField) == day), lambda row: F.struct(*_fields(row.getField))
        )

    days = [F.col("start"), F.date_add("start", 1)]
    feed = F.create_map(*(part for day in days for part in (day.cast("string"), on(day))))
    return grouped.select(F.to_json(F.struct(feed.alias(ENVELOPE_FIELD))).alias("value"))


def broken_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value STRING): an envelope of one object for every lineitem: cut short where 59 divides the order key,
    with a null beside the object where 67 does (and 59 does not), whole otherwise."""
    rows = _spread(_lineitem(spark, sf_dir)).withColumn("day", _day())
    listed = objects(rows.withColumn("case", F.when(_every(59), "cut").when(_every(67), "null").otherwise("whole")))
    fields = [name for name in listed.columns if name not in ("day", "case", "l_orderkey")]
    one = F.to_json(F.struct(*fields))
    list_of = F.when(F.col("case") == "null", F.concat(F.lit("[null,"), one, F.lit("]"))).otherwise(
        F.concat(F.lit("["), one, F.lit("]"))
    )
    whole = F.concat(F.lit(f'{{"{ENVELOPE_FIELD}":{{"'), F.col("day").cast("string"), F.lit('":'), list_of, F.lit("}}"))
    cut = F.expr("substring(whole, 1, length(whole) - 10)")
    return listed.withColumn("whole", whole).select(F.when(F.col("case") == "cut", cut).otherwise(F.col("whole")).alias("value"))


def form_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four inputs of every lineitem as the text a form would send."""
    return _spread(_lineitem(spark, sf_dir)).select(
        (_diameter() / 2.236).cast("string").alias("estimated_diameter_km_min"),
        _diameter().cast("string").alias("estimated_diameter_km_max"),
        _miss().cast("string").alias("miss_distance_km"),
        _velocity_text().alias("relative_velocity_km_s"),
    )
