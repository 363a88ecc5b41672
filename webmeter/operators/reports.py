"""Rates, quantiles, histograms, lag and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exponential_bounds(start: float, n: int, factor: float = 2.0) -> list[float]:
    return [start * factor**i for i in range(n)]


def histogram(values: DataFrame, value: str, bounds: list[float], by: list[str] | None = None) -> DataFrame:
    """Cumulative counts ``n`` of values up to each bound ``le`` (null: no bound), by group.

    Each value goes to one bucket before the aggregation; cumulation runs over
    the few buckets.
    """
    by = by or []
    place = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        place = F.when(F.col(value) <= bounds[i], i).otherwise(place)
    counted = values.where(F.col(value).isNotNull()).groupBy(*by, place.alias("i")).agg(F.count(F.lit(1)).alias("m"))
    # groups and buckets: a row each, so that empty buckets are there
    shape = counted.groupBy(*by).agg(F.collect_list(F.struct("i", "m")).alias("_m")) if by else counted.agg(F.collect_list(F.struct("i", "m")).alias("_m"))
    full = shape.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(bounds)))))
    total = F.aggregate("_m", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["i"] <= F.col("i"), x["m"]).otherwise(0))
    le = F.get(F.array(*(F.lit(float(b)) for b in bounds)), F.col("i"))
    return full.select(*by, "i", le.alias("le"), total.alias("n"))


def histogram_quantile(cumulative: DataFrame, q: float, by: list[str] | None = None) -> DataFrame:
    """Quantile by linear interpolation inside its bucket.

    The first bucket starts at 0; a rank beyond the last bound gives that
    bound; no observation gives null.
    """
    by = by or []
    part = Window.partitionBy(*by)
    order = part.orderBy("i")
    rows = cumulative.withColumns({"_total": F.max("n").over(part), "_before": F.coalesce(F.lag("n").over(order), F.lit(0)), "_low": F.coalesce(F.lag("le").over(order), F.lit(0.0)), "_top": F.max("le").over(part)})
    rank = F.lit(q) * F.col("_total")
    hit = rows.where((F.col("n") >= rank) & ((F.col("_before") < rank) | (F.col("i") == 0)))
    first = Window.partitionBy(*by).orderBy("i")
    hit = hit.withColumn("_k", F.row_number().over(first)).where("_k = 1")
    value = F.when(F.col("_total") == 0, F.lit(None).cast("double")).when(F.col("le").isNull(), F.col("_top")).otherwise(F.col("_low") + (F.col("le") - F.col("_low")) * (rank - F.col("_before")) / F.greatest(F.col("n") - F.col("_before"), F.lit(1)))
    return hit.select(*by, value.alias("value"))


def upper_rank_percentile(column: str, q: float) -> Column:
    """``sorted[ceil(q * n) - 1]``, 0 if there is no value."""
    return F.coalesce(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})"), F.lit(0))


def rate_per_second(events: DataFrame, ts: str, by: list[str] | None = None, window_s: int = 60) -> DataFrame:
    """Events a second in each tumbling window, by group."""
    start = F.floor(F.unix_seconds(ts) / window_s) * window_s
    return events.groupBy(start.cast("long").alias("window_start"), *(by or [])).agg((F.count(F.lit(1)) / float(window_s)).alias("per_second"))


def lag(offsets: DataFrame) -> DataFrame:
    """Adds the lag of each partition: end - max(committed, first), at least 0."""
    return offsets.withColumn("lag", F.greatest(F.col("end") - F.greatest("committed", "first"), F.lit(0)))


def zero_filled(counts: DataFrame, column: str, values: list, n: str = "n") -> DataFrame:
    """One row for each listed value, 0 where nothing was counted."""
    spark = counts.sparkSession
    kind = counts.schema[column].dataType
    listed = spark.createDataFrame([(v,) for v in values], f"{column} {kind.simpleString()}")
    return listed.join(counts, column, "left").select(column, F.coalesce(n, F.lit(0)).cast("long").alias(n))


def codes_text(counts: Column) -> Column:
    """``202:99 400:1`` from an array of (code, n)."""
    return F.array_join(F.transform(F.sort_array(counts), lambda c: F.concat_ws(":", c["code"].cast("string"), c["n"].cast("string"))), " ")


def ms_text(micros: Column) -> Column:
    """Microseconds as ``12.3 ms``."""
    return F.format_string("%.1f ms", micros / 1000.0)


def step_line(row: dict[str, Column]) -> Column:
    """One line of the table of steps, columns aligned to the right."""
    cells = [row["rate"].cast("string"), F.format_string("%.0f", row["accepted_per_s"]), row["dropped"].cast("string"), row["errors"].cast("string"), row["codes"], *(ms_text(row[p]) for p in ("p50", "p95", "p99", "max"))]
    widths = [8, 10, 8, 8, 28, 12, 12, 12, 12]
    return F.concat(*(F.lpad(x, w, " ") for x, w in zip(cells, widths, strict=True)))


def load_summary(requests: DataFrame, step: str, seconds: Column, latency: str = "latency_us") -> DataFrame:
    """Scheduled, dropped and failed requests, codes, accepted a second and latency percentiles of each step.

    Needs status (null: no answer) and dropped; a dropped request was never
    sent and has no latency.  A step without answers has percentiles of 0.
    """
    p = upper_rank_percentile
    sent = ~F.col("dropped")
    timed = requests.withColumn("_us", F.when(sent & F.col("status").isNotNull(), F.col(latency)))
    per_code = timed.groupBy(step, "status").agg(F.count(F.lit(1)).alias("_n"), F.count_if(sent).alias("_sent")).groupBy(step).agg(codes_text(F.collect_list(F.when(F.col("status").isNotNull() & (F.col("_sent") > 0), F.struct(F.col("status").alias("code"), F.col("_sent").alias("n"))))).alias("codes"))
    main = timed.groupBy(step).agg(
        F.count(F.lit(1)).alias("scheduled"),
        F.count_if("dropped").alias("dropped"),
        F.count_if(sent & F.col("status").isNull()).alias("errors"),
        (F.count_if(sent & (F.col("status") == 202)) / F.max(seconds)).alias("accepted_per_s"),
        *(p("_us", q).cast("long").alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))),
        F.coalesce(F.max("_us"), F.lit(0)).cast("long").alias("max"),
    )
    return main.join(per_code, step)


def open_loop(requests: DataFrame, worker: str, intended: str, service: str) -> DataFrame:
    """Adds ``done_us`` and ``wait_us`` of requests served one after the other by their worker.

    A request starts at its intended time or when the one before it is done,
    so that latency counts from the intended time: done = S + max(A - S before)
    with S the running sum of the services, two windows over one partitioning.
    """
    order = Window.partitionBy(worker).orderBy(intended, "seq")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = requests.withColumn("_sum", F.sum(service).over(upto))
    rows = rows.withColumn("done_us", F.col("_sum") + F.max(F.col(intended) - (F.col("_sum") - F.col(service))).over(upto))
    return rows.withColumn("wait_us", F.col("done_us") - F.col(intended)).drop("_sum")


def batch_metrics(batches: DataFrame, consumers: list[str]) -> DataFrame:
    """Batches by consumer and result, and messages of the batches that succeeded; zeros where nothing happened.

    Batches: consumer, size, result (ok or error).
    """
    spark = batches.sparkSession
    counted = batches.groupBy("consumer", "result").agg(F.count(F.lit(1)).alias("_batches"), F.sum("size").alias("_size"))
    series = spark.createDataFrame([(x, r) for x in consumers for r in ("ok", "error")], "consumer string, result string")
    zero = F.lit(0).cast("long")
    return series.join(counted, ["consumer", "result"], "left").select("consumer", "result", F.coalesce("_batches", zero).alias("batches"), F.when(F.col("result") == "ok", F.coalesce("_size", zero)).otherwise(zero).alias("messages"))


def top_lag(lags: DataFrame, by: str = "partition") -> DataFrame:
    """The largest lag by ``by``, and over all of them (``all``)."""
    one = lags.groupBy(F.col(by).cast("string").alias(by)).agg(F.max("lag").alias("lag"))
    return one.unionByName(lags.agg(F.max("lag").alias("lag")).select(F.lit("all").alias(by), "lag"))


def verify_verdict(want: dict[str, Column], got: dict[str, Column], stable: Column, timed_out: Column) -> Column:
    """ok, double_count, loss, timeout or wait: the first that holds."""
    equal = over = None
    for k in want:
        equal = (got[k] == want[k]) if equal is None else equal & (got[k] == want[k])
        over = (got[k] > want[k]) if over is None else over | (got[k] > want[k])
    return F.when(equal, "ok").when(over, "double_count").when(stable, "loss").when(timed_out, "timeout").otherwise("wait")
