"""Analytics over work packages and their audit events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.contracts import STATES
from seqloom.functions.scalar import exit_label
from seqloom.sources.scratch import materialize

#: Upper bounds in seconds of duration buckets (fixed values).
BUCKETS = [1, 5, 10, 30, 60, 120, 300, 600]
#: Price of a CPU hour.
CPU_HOUR = 0.0464


def state_counts(packages: DataFrame) -> DataFrame:
    """Packages in each state, states without any included."""
    spark = packages.sparkSession
    states = spark.createDataFrame([(s,) for s in STATES], "state string")
    return states.join(packages.groupBy("state").agg(F.count("*").alias("n")), "state", "left").select("state", F.coalesce("n", F.lit(0)).alias("n"))


def latest_state(events: DataFrame) -> DataFrame:
    """Each package's state after its last transition."""
    order = F.struct("timestamp", "attempt", "to_state")
    return events.groupBy("package_id").agg(F.max(order).alias("last")).select("package_id", F.col("last.to_state").alias("state"), F.col("last.timestamp").alias("since"))


def progress_pct(packages: DataFrame) -> DataFrame:
    """Percent of packages that are completed; null without packages."""
    return packages.agg((100.0 * F.count_if(F.col("state") == "COMPLETED") / F.nullif(F.count("*"), F.lit(0))).alias("progress_pct"))


def stale_packages(packages: DataFrame, now: Column, timeout_seconds: int) -> DataFrame:
    """Running packages without a heartbeat, or with one strictly older than the timeout, and why."""
    age = now.cast("double") - F.col("heartbeat_at").cast("double")
    reason = F.when(F.col("heartbeat_at").isNull(), F.lit(f"heartbeat never started, timeout {timeout_seconds}s")).otherwise(
        F.concat(F.lit("heartbeat stale: last seen "), F.date_format("heartbeat_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(f", timeout {timeout_seconds}s"))
    )
    return packages.where((F.col("state") == "RUNNING") & (F.col("heartbeat_at").isNull() | (age > timeout_seconds))).withColumn("reason", reason)


def retry_or_poison(failed: DataFrame) -> DataFrame:
    """Failed packages (with ``reason``) as they go on: pending again, or poisoned after ``max_attempts``; the claim is cleared."""
    attempt = F.col("attempt") + 1
    out = failed.withColumns({
        "state": F.when(attempt >= F.col("max_attempts"), "POISONED").otherwise("PENDING"),
        "error_history": F.array_append(F.coalesce("error_history", F.array().cast("array<string>")), F.col("reason")),
        "attempt": attempt,
    })
    cleared = {c: F.lit(None).cast(failed.schema[c].dataType) for c in ("claimed_by", "claimed_at", "heartbeat_at", "started_at") if c in failed.columns}
    return out.withColumns(cleared).drop("reason")


def duration_histogram(durations: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Cumulative counts of ``duration_s`` at each bucket's bound, and of all at infinity.

    All bounds are counted in one aggregation instead of a row for each bound and duration.
    """
    by = by or []
    sums = durations.groupBy(*by).agg(*[F.count_if(F.col("duration_s") <= b).alias(f"le{b}") for b in BUCKETS], F.count("duration_s").alias("leInf"))
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"le{b}").alias("n")) for b in BUCKETS] + [F.struct(F.lit(float("inf")).alias("le"), F.col("leInf").alias("n"))]
    return sums.select(*by, F.inline(F.array(*rows)))


def _bin(value: Column) -> Column:
    """A whole number that never falls as ``value`` grows: 64 bins for each doubling, on either side of zero."""
    side = lambda v: F.floor(F.log2(v) * 64) + 100_000
    far = F.lit(1_000_000).cast("long")
    inf = F.lit(float("inf"))
    return (
        F.when(F.isnan(value), far + 1).when(value == inf, far).when(value == -inf, -far).when(value > 0, side(value)).when(value < 0, -side(-value)).otherwise(F.lit(0).cast("long"))
    )


def _ranks_within(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``counts(*keys, order, n, ranks, ...)`` with ``ahead``, the rows before it in the order, and only with those ranks (from 0) that fall to it."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("ahead", F.sum("n").over(w) - F.col("n"))
    return placed.withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("ahead")) & (r < F.col("ahead") + F.col("n"))))


def exact_quantiles(values: DataFrame, keys: list[str], value: str, quantiles: list[float]) -> DataFrame:
    """``keys`` and ``p`` (an array: the exact quantiles of ``value``, linear between ranks) of each group; null where a group has no values.

    Two passes.  The first counts bins, a histogram that tasks combine, and finds the bins in which the wanted ranks fall.
    The second counts different values in these bins only.  No aggregation holds a group's values, and running sums go over
    bins and different values, not rows; so memory doesn't depend on how many rows a group has.
    """
    by = [f"_k{i}" for i in range(len(keys))]
    x = values.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], F.col(value).cast("double").alias("v")).withColumn("bin", F.when(F.col("v").isNotNull(), _bin(F.col("v"))))
    place = [(F.col("total") - 1) * F.lit(float(q)) for q in quantiles]
    ends = F.array_distinct(F.array(*[f(p).cast("long") for p in place for f in (F.floor, F.ceil)]))
    bins = x.groupBy(*by, "bin").agg(F.count("v").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    # Written, as its size then tells whether the second pass needs a shuffle of rows: it has a few bins a group.
    wanted = materialize(_ranks_within(bins.withColumn("ranks", F.when(F.col("total") > 0, ends).otherwise(F.array().cast("array<long>"))), by, "bin").where((F.size("ranks") > 0) | (F.col("total") == 0)), "wanted-bins")
    inside = wanted.select(*[F.col(b).alias(f"w{b}") for b in by], F.col("bin").alias("wbin"), F.transform("ranks", lambda r: r - F.col("ahead")).alias("ranks"), F.col("ahead").alias("base"), "total")
    met = x.join(inside, [*[F.col(f"w{b}").eqNullSafe(F.col(b)) for b in by], F.col("bin") == F.col("wbin")])
    each = met.groupBy(*by, "bin", "v").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("ranks", "base", "total")])
    found = _ranks_within(each, [*by, "bin"], "v").select(*by, "total", F.explode("ranks").alias("r"), "base", "v")
    per = found.groupBy(*by, "total").agg(F.map_from_entries(F.collect_list(F.struct(F.col("r") + F.col("base"), "v"))).alias("at"))  # twice the quantiles at most
    at = lambda p, f: F.element_at("at", f(p).cast("long"))
    between = [F.when(at(p, F.floor) == at(p, F.ceil), at(p, F.floor)).otherwise(at(p, F.floor) * (F.ceil(p) - p) + at(p, F.ceil) * (p - F.floor(p))) for p in place]
    none = wanted.where("total = 0").select(*by, F.lit(None).cast("array<double>").alias("p"))
    return per.select(*by, F.array(*between).alias("p")).unionByName(none).toDF(*keys, "p")


def duration_quantiles(durations: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Exact p50, p95 and p99 of ``duration_s`` in each window of ``ts``; a window without a duration has nulls."""
    placed = durations.select(F.window("ts", window)["start"].alias("window_start"), "duration_s")
    per = exact_quantiles(placed, ["window_start"], "duration_s", [0.5, 0.95, 0.99])
    return per.select("window_start", *[F.get("p", F.lit(i)).alias(f"p{q}") for i, q in enumerate((50, 95, 99))])


def throughput(work: DataFrame, seconds: int = 60) -> DataFrame:
    """Hits and sequences a second in each window."""
    sums = work.groupBy(F.window("ts", f"{seconds} seconds").alias("w")).agg(F.sum("hits").alias("h"), F.sum("sequences").alias("s"))
    return sums.select(F.col("w.start").alias("window_start"), (F.col("h") / seconds).alias("hits_per_s"), (F.col("s") / seconds).alias("sequences_per_s"))


def errors_by_type(runs: DataFrame) -> DataFrame:
    """Failures by label."""
    return runs.withColumn("error_type", exit_label(F.col("exit_code"))).where("error_type IS NOT NULL").groupBy("error_type").agg(F.count("*").alias("n"))


def exit_codes(runs: DataFrame, seconds: int = 60) -> DataFrame:
    """Counts and rates of exit codes in each window."""
    n = runs.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "exit_code").agg(F.count("*").alias("n"))
    return n.select(F.col("w.start").alias("window_start"), "exit_code", "n", (F.col("n") / seconds).alias("per_s"))


def cost_estimate(durations: DataFrame, rate: float = CPU_HOUR) -> DataFrame:
    """Cost of all durations, and for a million sequences."""
    out = durations.agg(F.sum("duration_s").alias("seconds"), F.sum("sequences").alias("sequences"))
    cost = F.col("seconds") * rate / 3600
    return out.select(cost.alias("cost"), (cost * 1e6 / F.nullif(F.col("sequences"), F.lit(0))).alias("cost_per_million"))


def eta(packages: DataFrame, rate: float = CPU_HOUR) -> DataFrame:
    """Seconds and cost that a run still needs: packages left times the mean duration, over the workers that are busy."""
    s = F.col("state")
    done = F.avg(F.when(s == "COMPLETED", F.col("duration_s")))
    sums = packages.agg(F.count_if(s.isin("PENDING", "RUNNING")).alias("remaining"), done.alias("mean_s"), F.countDistinct(F.when(s == "RUNNING", F.col("claimed_by"))).alias("workers"))
    work = F.col("remaining") * F.col("mean_s")
    return sums.select("remaining", "workers", (work / F.greatest("workers", F.lit(1))).alias("eta_s"), (work * rate / 3600).alias("cost_left"))


def package_history(events: DataFrame, package_id: str) -> DataFrame:
    """All transitions of one package in order."""
    return events.where(F.col("package_id") == package_id).orderBy("timestamp", "attempt").select("timestamp", "attempt", "from_state", "to_state", "worker_id", "reason")


def attempts(packages: DataFrame) -> DataFrame:
    """Each entry of the packages' error histories with its number."""
    return packages.select("package_id", F.posexplode("error_history").alias("attempt", "reason"))


def worker_summary(runs: DataFrame) -> DataFrame:
    """Packages, failures and seconds of each worker."""
    return runs.groupBy("worker_id").agg(F.count("*").alias("packages"), F.count_if(F.col("exit_code") != 0).alias("errors"), F.sum("duration_s").alias("seconds"))


def active_workers(runs: DataFrame, seconds: int = 3600) -> DataFrame:
    """Distinct workers in each window."""
    return runs.groupBy(F.window("ts", f"{seconds} seconds").alias("w")).agg(F.countDistinct("worker_id").alias("workers")).select(F.col("w.start").alias("window_start"), "workers")


def heartbeat_age(packages: DataFrame, now: Column) -> DataFrame:
    """Seconds since each worker's last heartbeat."""
    last = packages.where("claimed_by IS NOT NULL").groupBy(F.col("claimed_by").alias("worker_id")).agg(F.max("heartbeat_at").alias("at"))
    return last.select("worker_id", (now.cast("double") - F.col("at").cast("double")).alias("age_s"))


def quarantine_corrupt(lines: DataFrame, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSON lines in ``value``: what doesn't parse, or lacks a required field, is set aside."""
    parsed = lines.withColumn("r", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull() | reduce(lambda a, b: a | b, [F.col(f"r.{c}").isNull() for c in required])
    return parsed.where(~bad).select("r.*").drop("_bad"), parsed.where(bad).select("value")


def read_packages(spark: SparkSession, path: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Package files (one JSON document each), the corrupt ones apart."""
    return quarantine_corrupt(spark.read.option("wholetext", True).text(path), schema, required)
