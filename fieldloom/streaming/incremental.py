"""Incremental conversion, cursors, refresh checks and the run log."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldloom.operators.columns import q
from fieldloom.operators.mapping import Mapping, convert
from fieldloom.operators.windows import last_success
from fieldloom.sources import commits

#: A run of a step; counts holds what a step wants to tell besides.
RUN_COLUMNS = ("step", "index", "success", "task started", "task completed", "duration", "outputs", "counts")
RUN_SCHEMA = "step string, `index` int, success boolean, `task started` timestamp, `task completed` timestamp, duration double, outputs array<string>, counts map<string,long>"


def read_increment(spark: SparkSession, source: str, schema: T.StructType, source_format: str = "parquet", files_per_trigger: int = 64, **options) -> DataFrame:
    """Landed files as a stream; what a trigger takes is bounded."""
    reader = spark.readStream.format(source_format).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.options(**options).load(source)


def convert_incremental(
    stream: DataFrame, mapping: Mapping, dataset_id: str, event: str, column: str, target: str, checkpoint: str, prefix: str | None = None
) -> StreamingQuery:
    """Convert what has landed since the last run and stop; the checkpoint knows what is done, so a restart repeats nothing.

    Rows and checkpoint lie under a fingerprint of the settings: with another mapping, dataset or column everything that has
    landed is converted afresh, and readers go by the new rows; earlier settings, taken up again, go on where they were.
    Readers see a batch when all its events are written; one that is tried again replaces itself.
    """
    run = commits.fingerprint({k: list(t) for k, t in mapping.items()}, dataset_id, event, column, prefix, stream.schema.json())
    if commits.current(stream.sparkSession, target) != run:
        commits.begin(stream.sparkSession, target, run)

    def write(batch: DataFrame, number: int) -> None:
        commits.write_batch(convert(batch, mapping, dataset_id, event, column, prefix), target, run, number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{run}").trigger(availableNow=True).start()


def read_event(spark: SparkSession, target: str, event: str) -> DataFrame:
    """Rows of an event by the current settings, of whole batches alone."""
    return commits.read_table(spark, target, event)


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key hasn't been written yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def cursor(pages: DataFrame, page: str = "page") -> DataFrame:
    """The next page to ask for: one after the last that landed, 1 at the start."""
    return pages.agg((F.coalesce(F.max(q(page)), F.lit(0)) + 1).alias("next_page"))


#: Names of days as schedules write them, Monday first.
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def refresh_due(runs: DataFrame, schedule: DataFrame, as_of: str, key: str = "source", started: str = "started") -> DataFrame:
    """Whether each scheduled source is due on a day: schedule (key, type, interval, day, date), runs (key, started, success).

    Daily: the last run is at least interval days back. Weekly: not today, the weekday fits and the gap is more than
    7 (interval - 1) + 1 days. Monthly: a month begun since, interval months or more, and the date is reached or the month
    has no such date. What never ran is due.
    """
    now = F.lit(as_of).cast("date")
    last = runs.filter("success").groupBy(key).agg(F.max(F.col(started).cast("date")).alias("last"))
    joined = schedule.join(last, key, "left")
    gap = F.datediff(now, "last")
    weekday = F.array_position(F.array(*[F.lit(d) for d in DAYS]), F.lower("day")) - 1
    months = (F.year(now) - F.year("last")) * 12 + F.month(now) - F.month("last")
    reached = F.dayofmonth(now) >= F.least(F.col("date"), F.dayofmonth(F.last_day(now)))
    due = (
        F.when(F.col("last").isNull(), F.lit(True))
        .when(F.col("type") == "daily", gap >= F.col("interval"))
        .when(F.col("type") == "weekly", (gap > 0) & (F.weekday(now) == weekday) & (gap > 7 * (F.col("interval") - 1) + 1))
        .when(F.col("type") == "monthly", (months >= F.col("interval")) & reached)
        .otherwise(F.lit(False))
    )
    return joined.select(q(key), "last", due.alias("due"))


def log_run(spark: SparkSession, path: str, **run) -> None:
    """Append one run to the log."""
    row = tuple(run.get(n.replace(" ", "_")) for n in RUN_COLUMNS)
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(path)


def latest_runs(spark: SparkSession, path: str) -> DataFrame:
    """The latest successful run of each step."""
    return last_success(spark.read.parquet(path), keys=["step", "index"])


def step(inputs: int = 1) -> Callable:
    """Mark a function as a step: so many tables in front (negative: any number, 0: none), options after."""

    def mark(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(f)
        def run(*args, **options) -> DataFrame:
            frames = [a for a in args if isinstance(a, DataFrame)]
            if inputs >= 0 and len(frames) != inputs:
                raise ValueError(f"{f.__name__} takes {inputs} tables, not {len(frames)}")
            return f(*args, **options)

        run.inputs = inputs
        return run

    return mark


def map_inputs(
    spark: SparkSession, f: Callable[[DataFrame], DataFrame], paths: list[str], read: Callable[[SparkSession, str | list[str]], DataFrame], together: bool = False
) -> DataFrame:
    """The same step over many inputs, one each, united by name (T03); Spark runs them side by side.

    together: the inputs are read in one scan and the step is planned once, for steps that look at each row by itself and
    readers that take a list (``read_files`` places columns by each file's header); a plan then doesn't grow with the paths.
    """
    if together:
        return f(read(spark, paths))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f(read(spark, p)) for p in paths])


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Steps one after another; nothing is written between them."""
    return reduce(lambda d, f: d.transform(f), steps, df)
