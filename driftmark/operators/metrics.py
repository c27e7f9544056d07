"""Figures about freshness and work done, and the expressions of dashboards over metric samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftmark.session import materialize

# The upper bounds in seconds of the freshness histogram's buckets.
LAG_BUCKETS = (0.05, 0.1, 0.25, 0.5, 1, 2, 5, 10, 30, 60, 120, 300, 600, 1800)
PERCENTILES = (0.5, 0.95, 0.99)


def lag_seconds(later: Column, earlier: Column) -> Column:
    """The difference in seconds with microseconds."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def nearest_ranks(values: DataFrame, value: str, shares: Sequence[float]) -> DataFrame:
    """One row with the nearest-rank percentiles ``p0``, ``p1``, ... of a column; NaN without values.

    No task sees all values: they are counted by value, which the map side reduces, range-partitioned and sorted.
    The counts of the partitions, a row each, say in which partition each rank lies and how many values are before,
    and within a partition the rank is reached by running sums.
    """
    nan = F.lit(float("nan"))
    counted = values.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    parted = materialize(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "ranks")
    sizes = parted.groupBy("part").agg(F.sum("n").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.withColumns({"before": F.coalesce(F.sum("size").over(before), F.lit(0)), "total": F.sum("size").over(Window.partitionBy())})
    rank = lambda p: F.greatest(F.ceil(F.col("total") * F.lit(p)), F.lit(1))
    wanted = offsets.filter(reduce(Column.__or__, [(rank(p) > F.col("before")) & (rank(p) <= F.col("before") + F.col("size")) for p in shares]))
    own = parted.join(F.broadcast(wanted), "part")  # at most a row per share
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v")) + F.col("before")
    reached = own.withColumn("upto", upto)
    return reached.agg(*[F.coalesce(F.min(F.when(F.col("upto") >= rank(p), F.col("v"))), nan).alias(f"p{i}") for i, p in enumerate(shares)])


def throughput(count: Column, seconds: Column) -> Column:
    """Per second; NaN where no time passed."""
    return F.when(seconds != 0, count / seconds).otherwise(F.lit(float("nan")))


def histogram(values: DataFrame, value: str, bounds: Sequence[float] = LAG_BUCKETS) -> DataFrame:
    """(``le``, ``n``): how many values are at most each bound, and in all (``Infinity``).

    One pass with an aggregate per bound; the bounds are then rows by unpivoting one row.
    """
    counted = values.agg(*[F.count_if(F.col(value) <= float(b)).alias(f"b{i}") for i, b in enumerate(bounds)], F.count(value).alias(f"b{len(bounds)}"))
    stops = [*map(float, bounds), float("inf")]
    return counted.select(F.inline(F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(stops)])))


def histogram_quantile(buckets: DataFrame, q: float) -> DataFrame:
    """One row, ``value``: the quantile from cumulative counts, linear within its bucket.

    From the last bucket the greatest finite bound is returned; without observations NaN. A histogram has a
    fixed number of buckets, so the window over them is over a few rows.
    """
    w = Window.orderBy("le")
    b = buckets.withColumns({"low": F.coalesce(F.lag("le").over(w), F.lit(0.0)), "below": F.coalesce(F.lag("n").over(w), F.lit(0)), "total": F.max("n").over(Window.partitionBy())})
    hit = b.filter((F.col("n") >= F.lit(q) * F.col("total")) & (F.col("total") > 0))
    first = hit.agg(F.min_by(F.struct("le", "low", "below", "n", "total"), "le").alias("b"))
    inside = F.col("b.low") + (F.col("b.le") - F.col("b.low")) * (F.lit(q) * F.col("b.total") - F.col("b.below")) / (F.col("b.n") - F.col("b.below"))
    value = F.when(F.col("b").isNull(), F.lit(float("nan"))).when(F.col("b.le") == F.lit(float("inf")), F.col("b.low")).when(F.col("b.n") == F.col("b.below"), F.col("b.le")).otherwise(inside)
    return first.select(value.alias("value"))


def counter_deltas(samples: DataFrame, series: Sequence[str], order: Sequence[str] = ("ts",), block: str = "6 hours") -> DataFrame:
    """The samples with ``delta``: the growth since the sample before; after a reset the value itself.

    A series is cut into blocks of time (of 4,096 numbers where the order is one), so that one with a third of all samples is spread over as many tasks; the
    first sample of a block is compared with the last of the block before, of which there is a row per block.
    """
    timed = dict(samples.dtypes)[order[0]].startswith("timestamp")
    cut = samples.withColumn("dm_block", F.window(order[0], block)["start"] if timed else F.floor(F.col(order[0]) / 4096))
    last = cut.groupBy(*series, "dm_block").agg(F.max_by("value", F.struct(*order)).alias("dm_last"))
    carried = last.withColumn("dm_carried", F.lag("dm_last").over(Window.partitionBy(*series).orderBy("dm_block"))).drop("dm_last")
    within = F.lag("value").over(Window.partitionBy(*series, "dm_block").orderBy(*order))
    numbered = cut.withColumn("dm_before", within)
    keys = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*series, "dm_block")]
    both = numbered.alias("a").join(carried.alias("b"), reduce(Column.__and__, keys), "left").select("a.*", "b.dm_carried")
    before = F.coalesce("dm_before", "dm_carried")
    return both.withColumn("delta", F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)).drop("dm_block", "dm_before", "dm_carried")


def increase(samples: DataFrame, series: Sequence[str], window: str, by: Sequence[str] = (), order: Sequence[str] = ("ts",)) -> DataFrame:
    """(``window_start``, ..., ``increase``, ``rate``) of counters, summed over series by the ``by`` columns.

    Plain differences, not extrapolated to the edges of the window.
    """
    d = counter_deltas(samples, series, order).withColumn("w", F.window("ts", window))
    out = d.groupBy("w", *by).agg(F.sum("delta").alias("increase"))
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return out.select(F.col("w.start").alias("window_start"), *by, "increase", (F.col("increase") / seconds).alias("rate"))


def latest_gauges(samples: DataFrame, series: Sequence[str], order: Sequence[str] = ("ts",)) -> DataFrame:
    """One row: ``total`` and ``greatest`` of the last value of each series."""
    last = samples.groupBy(*series).agg(F.max_by("value", F.struct(*order)).alias("value"))
    return last.agg(F.sum("value").alias("total"), F.max("value").alias("greatest"))


def reuse_ratio(reused: Column, embedded: Column) -> Column:
    """The share of chunks that needed no embedding; 0 without chunks."""
    return reused / F.greatest(reused + embedded, F.lit(1))


def consumer_lag(high: Column, position: Column) -> Column:
    """Messages behind the end of a partition; an unknown position (below 0) lags by nothing."""
    return F.greatest(high - F.when(position >= 0, position).otherwise(high), F.lit(0))


SAMPLE = "ts timestamp, name string, label string, value double"


def batch_samples(results: DataFrame, events: int, malformed: int, as_of: Column) -> DataFrame:
    """What one batch added to the counters, as (``ts``, ``name``, ``label``, ``value``) rows.

    ``results`` has a row per document with its outcome and what was done to its chunks; all are counted in one
    aggregation by outcome. The lags of applied documents are counted by bucket.
    """
    per = results.groupBy("outcome").agg(F.count(F.lit(1)).alias("documents"), *[F.sum(f"chunks_{c}").alias(c) for c in ("embedded", "reused", "deleted")])
    by_outcome = per.select(F.lit("documents_total").alias("name"), F.col("outcome").alias("label"), F.col("documents").cast("double").alias("value"))
    chunks = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in ("embedded", "reused", "deleted")]).unpivot([], ["embedded", "reused", "deleted"], "label", "value").select(F.lit("chunks_total").alias("name"), "label", "value")
    lags = histogram(results.filter("lag_seconds IS NOT NULL"), "lag_seconds").select(F.lit("freshness_lag_seconds").alias("name"), F.col("le").cast("string").alias("label"), F.col("n").cast("double").alias("value"))
    counted = results.sparkSession.createDataFrame([("events_total", "valid", float(events)), ("events_total", "malformed", float(malformed))], "name string, label string, value double")
    return by_outcome.unionByName(chunks).unionByName(lags).unionByName(counted).select(as_of.alias("ts"), "name", "label", "value")


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of all batches as running totals (``ts``, ``name``, ``label``, ``value``). A series has a row per
    batch, and there are a few dozen series."""
    added = spark.read.schema(SAMPLE + ", batch string").parquet(path)
    running = Window.partitionBy("name", "label").orderBy("ts", "batch").rowsBetween(Window.unboundedPreceding, 0)
    return added.select("ts", "name", "label", F.sum("value").over(running).alias("value"))


def grown(before: DataFrame, after: DataFrame) -> DataFrame:
    """How much the last values of counters grew between two readings (``name``, ``label``, ``value``)."""
    last = lambda rows, name: rows.groupBy("name", "label").agg(F.max_by("value", "ts").alias(name))
    return last(after, "now").join(last(before, "then"), ["name", "label"], "left").select("name", "label", (F.col("now") - F.coalesce("then", F.lit(0.0))).alias("value"))
