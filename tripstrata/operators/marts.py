"""Summary tables built from clean trips."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tripstrata.functions.columns import col, find_column, require_column
from tripstrata.functions.times import minutes_between, seconds_between
from tripstrata.names import LABEL
from tripstrata.spec import DatasetSpec

PERCENTILES = {"median_duration_min": Decimal("0.5"), "p90_duration_min": Decimal("0.9")}


# Amounts are summed as decimals with four places, up to 10^14 each and 10^24 together.
AMOUNT = "decimal(18,4)"
MONTH = ("pickup_year", "pickup_month")
SKETCH_SIZE = 2000
# Fixed value: tasks that take samples of counted durations.
SAMPLING_TASKS = 16


def demand_patterns(trips: DataFrame) -> DataFrame:
    """Trips per type, pickup zone, day of week (1 = Sunday) and hour."""
    return _demand(trips)


def demand_parts(trips: DataFrame) -> DataFrame:
    """``demand_patterns`` of each month; the parts add up to those of all months."""
    return _demand(trips, *MONTH)


def merge_demand(parts: DataFrame) -> DataFrame:
    keys = (LABEL, "PULocationID", "pickup_dow", "pickup_hour")
    return parts.groupBy(*keys).agg(F.sum("trip_count").alias("trip_count"))


def _demand(trips: DataFrame, *month: str) -> DataFrame:
    return trips.groupBy(
        LABEL,
        "PULocationID",
        F.dayofweek("pickup_datetime").alias("pickup_dow"),
        F.hour("pickup_datetime").alias("pickup_hour"),
        *month,
    ).agg(F.count(F.lit(1)).alias("trip_count"))


def amount(df: DataFrame, name: str) -> Column:
    """A money column as an exact decimal, so that sums do not depend on the order of rows.

    NaN, which pandas writes for a missing number, is NULL. Further places are rounded. An amount of
    10^14 or more, or an infinite one, is an error when it is read, whatever the session's settings.
    """
    value = col(name)
    if isinstance(df.schema[find_column(df, equals_ci=name)].dataType, (FloatType, DoubleType)):
        value = F.when(~F.isnan(value), value)
    exact = value.try_cast(AMOUNT)
    wrong = F.raise_error(F.concat(F.lit(f"{name} is out of range: "), value.cast("string")))
    return F.when(value.isNull() | exact.isNotNull(), exact).otherwise(wrong.cast(AMOUNT))


def revenue_by_zone_hour(
    df: DataFrame, label: str, ts: str, zone: str, fare: str, tips: str, total: str | None = None
) -> DataFrame:
    """Fare, tips, revenue and trips of one source per pickup zone and hour.

    Without a reported total, revenue is the sum of fares plus the sum of tips, and NULL when a
    group has no fare or no tip at all. The label is attached after grouping, so it is neither
    hashed nor shuffled. Sums are exact (see ``amount``) and become doubles at the very end.
    """
    return _as_revenue(_revenue_sums(df, label, ts, zone, fare, tips, total))


def _revenue_sums(
    df: DataFrame,
    label: str,
    ts: str,
    zone: str,
    fare: str,
    tips: str,
    total: str | None,
    month: tuple[str, ...] = (),
) -> DataFrame:
    """Exact sums that can be added to others; ``total`` is NULL for sources that report none."""
    reported = F.sum(amount(df, total)) if total else F.lit(None).cast("decimal(28,4)")
    grouped = df.groupBy(
        col(zone).cast("int").alias("PULocationID"),
        F.hour(col(ts)).alias("pickup_hour"),
        *[col(name) for name in month],
    ).agg(
        F.sum(amount(df, fare)).alias("fare"),
        F.sum(amount(df, tips)).alias("tips"),
        reported.alias("total"),
        F.count(F.lit(1)).alias("trip_count"),
    )
    return grouped.select(
        F.lit(label).alias(LABEL), F.lit(total is not None).alias("has_total"), *grouped.columns
    )


def _as_revenue(sums: DataFrame) -> DataFrame:
    earned = F.when(F.col("has_total"), F.col("total")).otherwise(F.col("fare") + F.col("tips"))
    return sums.select(
        LABEL,
        "PULocationID",
        "pickup_hour",
        F.col("fare").cast("double").alias("total_fare"),
        F.col("tips").cast("double").alias("total_tips"),
        earned.cast("double").alias("total_revenue"),
        "trip_count",
    )


def revenue_parts(
    sources: Mapping[str, DataFrame], specs: Mapping[str, DatasetSpec]
) -> DataFrame:
    """Exact sums per type, zone, hour and month, to be put together by ``merge_revenue``."""
    return _each_source(sources, specs, _revenue_sums, MONTH)


def merge_revenue(parts: DataFrame) -> DataFrame:
    keys = (LABEL, "has_total", "PULocationID", "pickup_hour")
    names = ("fare", "tips", "total", "trip_count")
    return _as_revenue(parts.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names]))


def revenue(
    sources: Mapping[str, DataFrame], specs: Mapping[str, DatasetSpec]
) -> DataFrame:
    """Revenue per type, zone and hour. Each source is summed up first and the small results are
    stacked; sources without fares have no rows."""
    return _as_revenue(_each_source(sources, specs, _revenue_sums, ()))


def _each_source(sources, specs, summed, month: tuple[str, ...]) -> DataFrame:
    frames = []
    for label, df in sources.items():
        spec = specs[label]
        if spec.money is None:
            continue
        frames.append(
            summed(
                df,
                label,
                require_column(df, spec.pickup, "pickup time"),
                require_column(df, spec.pickup_zone, "pickup zone"),
                spec.money.fare,
                spec.money.tips,
                spec.money.total,
                month,
            )
        )
    if not frames:
        raise ValueError("no source has fares")
    return reduce(DataFrame.unionByName, frames)


def duration_stats(trips: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Count, mean, median, 90th percentile, minimum and maximum trip minutes per type.

    By default trips are first counted per type and whole second, which gives exact percentiles (see
    ``_exact_stats``) from a table that does not grow with the number of trips. With
    ``accuracy``, ``percentile_approx`` runs over evenly spaced trips instead (see ``_approximate_stats``),
    with ranks that are off by ``1 / accuracy`` of the trips at most.
    """
    if accuracy is not None:
        return _approximate_stats(trips, accuracy)
    return _exact_stats(duration_histogram(trips))


def duration_histogram(trips: DataFrame, month: tuple[str, ...] = ()) -> DataFrame:
    seconds = seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return trips.groupBy(LABEL, seconds.alias("seconds"), *month).agg(F.count(F.lit(1)).alias("trips"))


def duration_parts(trips: DataFrame) -> DataFrame:
    """Trips per type, whole second and month, to be put together by ``merge_durations``."""
    return duration_histogram(trips, MONTH)


def merge_durations(parts: DataFrame) -> DataFrame:
    return _exact_stats(parts.groupBy(LABEL, "seconds").agg(F.sum("trips").alias("trips")))


def _exact_stats(histogram: DataFrame) -> DataFrame:
    """All statistics from the counts per second; percentiles in two steps.

    Counts per hour tell which hour holds each percentile and its rank in there; then only the seconds
    of that hour are ranked. So what comes together in one place is a row per hour that the durations
    span, and a row per second of one hour, also where junk dates give durations of years.

    Both steps need the histogram. Neither filters it before it is shuffled, and hours are compared
    with NULL as a value, from which no filter follows either: so the two have the same exchange, Spark
    runs it once, and the trips are scanned once.
    """
    by_hour = histogram.withColumn(
        "hour", F.floor(F.col("seconds") / F.lit(3600)).cast("long")
    )
    product = (F.col("seconds") * F.col("trips")).cast("decimal(38,0)")
    hours = by_hour.groupBy(LABEL, "hour").agg(
        F.sum("trips").alias("n"),
        F.min("seconds").alias("least"),
        F.max("seconds").alias("most"),
        F.sum(product).alias("total"),
    )
    known = F.when(F.col("hour").isNotNull(), F.col("n"))
    by_type = hours.groupBy(LABEL).agg(
        _counts("hour", "n", F.col("hour").isNotNull()),
        F.sum(known).alias("known"),
        F.sum("n").alias("trip_count"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("total").alias("total"),
    )
    ranks = [
        F.struct(
            F.lit(name).alias("name"),
            F.greatest(F.ceil(F.lit(share) * F.col("known")), F.lit(1)).cast("long").alias("rank"),
        )
        for name, share in PERCENTILES.items()
    ]
    totals = ("trip_count", "known", "least", "most", "total")
    wanted = (
        by_type.select(LABEL, *totals, "counts", F.explode(F.array(*ranks)).alias("p"))
        .select(LABEL, *totals, "p.name", "p.rank", _locate(F.col("counts"), F.col("p.rank")).alias("at"))
        .select(
            F.col(LABEL).alias("type"),
            *totals,
            "name",
            F.col("at.value").alias("at_hour"),
            (F.col("rank") - F.col("at.before")).alias("rank"),
        )
    )
    same = by_hour[LABEL].eqNullSafe(wanted["type"]) & by_hour["hour"].eqNullSafe(wanted["at_hour"])
    picked = (
        by_hour.join(wanted, same)
        .groupBy("type", "name", "rank", *totals)
        .agg(_counts("seconds", "trips", F.col("seconds").isNotNull()))
        .withColumn("at", _locate(F.col("counts"), F.col("rank"))["value"])
    )
    return (
        picked.groupBy(F.col("type").alias(LABEL), *totals)
        .agg(*[F.max(F.when(F.col("name") == name, F.col("at"))).alias(name) for name in PERCENTILES])
        .select(
            LABEL,
            "trip_count",
            _minutes(F.col("total").cast("double") / F.col("known")).alias("avg_duration_min"),
            *[_minutes(F.col(name)).alias(name) for name in PERCENTILES],
            _minutes(F.col("least")).alias("min_duration_min"),
            _minutes(F.col("most")).alias("max_duration_min"),
        )
    )


def _counts(value: str, n: str, use: Column) -> Column:
    pair = F.struct(F.col(value).cast("long").alias("value"), F.col(n).cast("long").alias("n"))
    return F.sort_array(F.collect_list(F.when(use, pair))).alias("counts")


def _locate(counts: Column, rank: Column) -> Column:
    """The value that holds the rank in sorted (value, n) pairs, and how many are before it."""
    start = F.struct(F.lit(None).cast("long").alias("value"), F.lit(0).cast("long").alias("before"))

    def step(state, pair):
        reached = state["before"] + pair["n"] >= rank
        following = F.struct(
            F.when(reached, pair["value"]).alias("value"),
            F.when(reached, state["before"]).otherwise(state["before"] + pair["n"]).alias("before"),
        )
        return F.when(state["value"].isNotNull(), state).otherwise(following)

    return F.aggregate(counts, start, step)


def duration_sketches(trips: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per type and month the count, sum and extremes of durations, and a sketch of them (KLL).

    A sketch takes up a few KB whatever the number of trips. A task adds its own trips up first, and a
    month's sketches meet where the month's counts do, so no reducer gets samples from every task. The rank of
    a percentile is off by ``1.33 % * (200 / size) ** 0.9`` of the trips at most, 0.17 % by default, with
    a confidence of 99 %; ``duration_parts`` are exact and larger by the number of distinct seconds.
    """
    seconds = seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    timed = trips.select(LABEL, *MONTH, seconds.alias("seconds"))
    return timed.groupBy(LABEL, *MONTH).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("seconds").alias("known"),
        F.sum(F.col("seconds").cast("decimal(28,0)")).alias("total"),
        F.min("seconds").alias("least"),
        F.max("seconds").alias("most"),
        F.kll_sketch_agg_bigint("seconds", size).alias("sketch"),
    )


def merge_duration_sketches(parts: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """The columns of ``duration_stats`` from monthly sketches, and the merged sketch itself."""
    merged = parts.groupBy(LABEL).agg(
        F.sum("trips").alias("trip_count"),
        F.sum("known").alias("known"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_bigint("sketch", size).alias("sketch"),
    )
    known = F.col("known") > 0

    def at(share: Decimal) -> Column:
        value = F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(share)))
        return F.when(known, _minutes(value))

    mean = F.when(known, F.col("total").cast("double") / F.col("known"))
    return merged.select(
        LABEL,
        "trip_count",
        _minutes(mean).alias("avg_duration_min"),
        *[at(share).alias(name) for name, share in PERCENTILES.items()],
        _minutes(F.col("least")).alias("min_duration_min"),
        _minutes(F.col("most")).alias("max_duration_min"),
        "sketch",
    )


def _minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60.0), 2)


def _approximate_stats(trips: DataFrame, accuracy: int) -> DataFrame:
    """``percentile_approx`` over at most ``2 * accuracy`` trips of each type, whatever their number.

    Over all trips, every map task sends up to ``accuracy`` samples per type, and one task puts all of
    them together, one after the other. So trips are counted per type and whole second first, and of a type with
    more trips those at evenly spaced ranks are taken. That, like the samples, moves a rank by half of
    ``1 / accuracy`` of the trips at most. Count, mean and extremes are those of all trips.
    """
    spread = _evenly(duration_histogram(trips), 2 * accuracy).repartition(SAMPLING_TASKS, LABEL, "seconds", "copy")
    once = F.coalesce(F.col("copy"), F.lit(1)) == 1
    timed = F.when(once & F.col("seconds").isNotNull(), F.col("trips"))
    taken = F.when(F.col("copy").isNotNull(), F.col("seconds"))
    merged = spread.groupBy(LABEL).agg(
        F.sum(F.when(once, F.col("trips"))).alias("trip_count"),
        F.sum(timed).alias("known"),
        F.sum((F.col("seconds") * timed).cast("decimal(38,0)")).alias("total"),
        F.min("seconds").alias("least"),
        F.max("seconds").alias("most"),
        *[
            F.percentile_approx(taken, float(share), 4 * accuracy).alias(name)
            for name, share in PERCENTILES.items()
        ],
    )
    return merged.select(
        LABEL,
        "trip_count",
        _minutes(F.col("total").cast("double") / F.col("known")).alias("avg_duration_min"),
        *[_minutes(F.col(name)).alias(name) for name in PERCENTILES],
        _minutes(F.col("least")).alias("min_duration_min"),
        _minutes(F.col("most")).alias("max_duration_min"),
    )


def _evenly(histogram: DataFrame, most: int) -> DataFrame:
    """``histogram`` with a row, numbered by ``copy``, for each of ``most`` evenly spaced ranks of a type, or of
    all its trips if there are fewer. A second in which none lies has one row without a number.

    Ranks are counted within each hour, and hours added up, as in ``_exact_stats``: no task gets more than
    the seconds of an hour or the hours of a type.
    """
    by_hour = histogram.withColumn("hour", F.floor(F.col("seconds") / F.lit(3600)).cast("long"))
    up_to = Window.partitionBy("type").orderBy("at_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = (
        by_hour.groupBy(F.col(LABEL).alias("type"), F.col("hour").alias("at_hour"))
        .agg(F.sum("trips").alias("n"))
        .withColumn("n", F.when(F.col("at_hour").isNotNull(), F.col("n")))
        .withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
        .withColumn("known", F.sum("n").over(Window.partitionBy("type")))
        .drop("n")
    )
    same = by_hour[LABEL].eqNullSafe(hours["type"]) & by_hour["hour"].eqNullSafe(hours["at_hour"])
    within = Window.partitionBy(LABEL, "hour").orderBy("seconds").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.col("before") + F.col("so_far")
    scale = F.least(F.lit(most).cast("long"), F.col("known"))

    def ranks(reached: Column) -> Column:
        return F.call_function("div", reached * scale, F.col("known"))

    copies = F.when(F.col("seconds").isNotNull(), ranks(rank) - ranks(rank - F.col("trips")))
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    return (
        by_hour.join(hours, same)
        .withColumn("so_far", F.sum("trips").over(within))
        .withColumn("copies", copies)
        .select(LABEL, "seconds", "trips", F.explode_outer(numbers).alias("copy"))
    )
