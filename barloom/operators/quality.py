"""Data-quality scores per ticker: freshness, completeness, outliers, gaps.

`as_of` stands for today and is always explicit. Freshness reads two columns of
the whole history; the other three checks share one windowed pass over the
recent bars, so all four cost one partial aggregation and one shuffle of about
225 days of bars.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import ladder, lit_or_col, rounded, whole_hours
from barloom.operators.returns import series
from barloom.operators.rolling import OUTLIER_ROWS, with_z_scores

# fixed values: check names and the score below which a check fails
FRESHNESS, COMPLETENESS, OUTLIERS, GAPS = "freshness", "completeness", "outliers", "gaps"
FAILING = 0.7


@dataclass(frozen=True)
class Thresholds:
    freshness_hours: int = 26
    completeness_days: int = 30
    history_days: int = 180
    warmup_days: int = 45
    short_gap_days: int = 3
    large_gap_days: int = 5
    outlier_z: float = 3.0


DEFAULTS = Thresholds()


@dataclass(frozen=True)
class Check:
    """One check over a ticker's profile row: when it applies, its score, its details."""

    name: str
    applies: Column
    score: Column
    details: list[Column]


def _freshness(t: Thresholds) -> Check:
    hours, limit = F.col("hours_since_ingest"), t.freshness_hours
    steps = [(hours <= limit, 1.0), (hours <= 2 * limit, 0.7), (hours <= 4 * limit, 0.4)]
    details = [hours, F.col("last_ingested"), F.col("latest_date")]
    return Check(FRESHNESS, F.lit(True), ladder(hours, steps, 0.1), details)


def _completeness(t: Thresholds) -> Check:
    days = F.col("total_days")
    ratio = days / F.lit(t.completeness_days * 5 / 7)  # weekdays stand in for trading days
    steps = [(ratio >= 0.95, 1.0), (ratio >= 0.85, 0.8), (ratio >= 0.70, 0.5)]
    details = [
        days,
        F.col("gaps_detected"),
        F.col("max_gap_days"),
        rounded(ratio, 3).alias("coverage_ratio"),
    ]
    return Check(COMPLETENESS, days > 0, ladder(ratio, steps, 0.2), details)


def _outliers() -> Check:
    points = F.col("total_points")
    rate = F.try_divide(F.col("outlier_count"), points)
    steps = [(rate == 0, 1.0), (rate < 0.01, 0.9), (rate < 0.03, 0.6)]
    details = [
        F.col("outlier_count"),
        points,
        rounded(rate, 4).alias("outlier_rate"),
        rounded("max_z_score", 2).alias("max_z_score"),
    ]
    return Check(OUTLIERS, points > 0, ladder(rate, steps, 0.3), details)


def _gaps() -> Check:
    gaps, moves = F.col("large_gaps"), F.col("total_transitions")
    steps = [(gaps == 0, 1.0), (gaps <= 2, 0.8), (gaps <= 5, 0.5)]
    return Check(GAPS, moves > 0, ladder(gaps, steps, 0.2), [gaps, moves, F.col("widest_gap_days")])


def _typed(profile: DataFrame, check: Check, as_of: date | Column) -> DataFrame:
    return profile.where(check.applies).select(
        lit_or_col(as_of).alias("check_date"),
        "ticker",
        F.lit(check.name).alias("check_name"),
        check.score.alias("score"),
        *check.details,
    )


def _freshness_profile(prices: DataFrame, as_of_time: datetime | Column) -> DataFrame:
    hours = whole_hours(F.col("last_ingested"), lit_or_col(as_of_time))
    return (
        prices.groupBy("ticker")
        .agg(F.max("ingested_at").alias("last_ingested"), F.max("date").alias("latest_date"))
        .withColumn("hours_since_ingest", hours)
    )


def quality_freshness(
    prices: DataFrame,
    as_of: date | Column,
    as_of_time: datetime | Column,
    thresholds: Thresholds = DEFAULTS,
) -> DataFrame:
    """Whole hours since a ticker's last ingest."""
    return _typed(_freshness_profile(prices, as_of_time), _freshness(thresholds), as_of)


def recent_profile(
    prices: DataFrame, as_of: date | Column, thresholds: Thresholds = DEFAULTS
) -> DataFrame:
    """One row per ticker with what completeness, outliers and gaps need.

    A transition counts for a check when both its bars lie in that check's days.
    """
    t, today = thresholds, lit_or_col(as_of)
    month = F.date_sub(today, t.completeness_days)
    history = F.date_sub(today, t.history_days)
    source = F.date_sub(today, t.history_days + t.warmup_days)

    recent = prices.select("ticker", "date", "close").where(F.col("date") >= source)
    frame = (
        with_z_scores(recent)
        .withColumn("prev_date", F.lag("date").over(series()))
        .withColumn("gap", F.datediff("date", "prev_date"))
        .withColumn("in_month", F.col("prev_date") >= month)
        .withColumn("in_history", F.col("prev_date") >= history)
        .withColumn("z", F.when(F.col("date") >= history, F.col("z_score")))
    )
    gap = F.col("gap")
    return frame.groupBy("ticker").agg(
        F.count_if("in_month").alias("total_days"),
        F.count_if(F.col("in_month") & (gap > t.short_gap_days)).alias("gaps_detected"),
        F.max(F.when(F.col("in_month"), gap)).alias("max_gap_days"),
        F.count_if("in_history").alias("total_transitions"),
        F.count_if(F.col("in_history") & (gap > t.large_gap_days)).alias("large_gaps"),
        F.max(F.when(F.col("in_history"), gap)).alias("widest_gap_days"),
        F.count("z").alias("total_points"),
        F.count_if(F.col("z") > t.outlier_z).alias("outlier_count"),
        F.max("z").alias("max_z_score"),
    )


def quality_completeness(prices, as_of, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Transitions of the last 30 days against the expected weekdays."""
    return _typed(recent_profile(prices, as_of, thresholds), _completeness(thresholds), as_of)


def quality_outliers(prices, as_of, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Share of closes far from their trailing mean."""
    return _typed(recent_profile(prices, as_of, thresholds), _outliers(), as_of)


def quality_gaps(prices, as_of, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Long pauses between bars."""
    return _typed(recent_profile(prices, as_of, thresholds), _gaps(), as_of)


def quality_scores(
    prices: DataFrame,
    as_of: date | Column,
    as_of_time: datetime | Column,
    thresholds: Thresholds = DEFAULTS,
) -> DataFrame:
    """Score rows of all four checks, the detail columns of each as JSON."""

    def scored(profile: DataFrame, checks: list[Check]) -> DataFrame:
        entries = [
            F.when(
                c.applies,
                F.struct(
                    F.lit(c.name).alias("check_name"),
                    c.score.alias("score"),
                    F.to_json(F.struct(*c.details)).alias("details"),
                ),
            )
            for c in checks
        ]
        rows = profile.select("ticker", F.explode(F.array_compact(F.array(*entries))).alias("check"))
        return rows.select(lit_or_col(as_of).alias("check_date"), "ticker", "check.*")

    t = thresholds
    fresh = scored(_freshness_profile(prices, as_of_time), [_freshness(t)])
    recent = scored(recent_profile(prices, as_of, t), [_completeness(t), _outliers(), _gaps()])
    return fresh.unionByName(recent).withColumn("checked_at", lit_or_col(as_of_time))


# -- scores of many days -------------------------------------------------------

COUNTS = ("total_days", "total_transitions", "large_gaps", "total_points", "outlier_count")


def _span(start: Column, end: Column, first: Column, last: Column, **amounts: Column) -> Column:
    """What is added on the first day of a span of days and taken away after its last."""
    begin = F.greatest(start, first)

    def change(day: Column, sign: int) -> Column:
        values = [(amounts.get(c, F.lit(0)) * sign).cast("bigint").alias(c) for c in COUNTS]
        return F.struct(day.alias("day"), *values)

    after = F.date_add(end, 1)
    return (
        F.when((end < begin) | (begin > last), F.array())
        .when(after > last, F.array(change(begin, 1)))
        .otherwise(F.array(change(begin, 1), change(after, -1)))
    )


def _z_within(bars: Column, since: Column) -> Column:
    """|z| of `close` against those of the bars before it that are not older than `since`."""
    start = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "total", "mean", "m2")])

    def add(s: Column, bar: Column) -> Column:
        n, delta = s["n"] + 1.0, bar["close"] - s["mean"]
        mean = s["mean"] + delta / n
        m2 = s["m2"] + delta * (bar["close"] - mean)
        total = s["total"] + bar["close"]
        return F.struct(n.alias("n"), total.alias("total"), mean.alias("mean"), m2.alias("m2"))

    def z(s: Column) -> Column:
        std = F.sqrt(F.try_divide(s["m2"], s["n"] - 1.0))
        return F.when(std > 0, F.abs((F.col("close") - s["total"] / s["n"]) / std))

    known = F.filter(bars, lambda bar: (bar["date"] >= since) & bar["close"].isNotNull())
    return F.aggregate(known, start, add, z)


def _changes_of_bar(first: Column, last: Column, t: Thresholds) -> Column:
    """A bar's changes of the counts, by as-of day: it enters a check's days when it is
    known and leaves them when its transition, or for outliers the bar itself, is too old."""
    day, prev, gap = F.col("date"), F.col("prev_date"), F.col("gap")
    one, reach = F.lit(1), t.history_days + t.warmup_days
    flag = lambda condition: F.coalesce(condition.cast("int"), F.lit(0))
    month = _span(day, F.date_add(prev, t.completeness_days), first, last, total_days=one)
    history = _span(
        day,
        F.date_add(prev, t.history_days),
        first,
        last,
        total_transitions=one,
        large_gaps=flag(gap > t.large_gap_days),
    )

    def outliers(start: Column, end: Column, z: Column) -> Column:
        counted = {"total_points": flag(z.isNotNull()), "outlier_count": flag(z > t.outlier_z)}
        return _span(start, end, first, last, **counted)

    leaves = F.least(last, F.date_add(day, t.history_days))
    # where the warm-up days cut bars off that z looks back to, z differs from day to day
    whole = F.coalesce(F.array_min("seen.date") >= F.date_sub(leaves, reach), F.lit(True))
    as_of_days = F.sequence(F.greatest(day, first), leaves)
    each = F.transform(
        as_of_days, lambda d: outliers(d, d, _z_within(F.col("seen"), F.date_sub(d, reach)))
    )
    of_z = F.when(whole, outliers(day, leaves, F.col("z_score"))).otherwise(F.flatten(each))
    moved = F.when(prev.isNotNull(), F.concat(month, history)).otherwise(F.array())
    point = F.when(F.greatest(day, first) <= leaves, of_z).otherwise(F.array())
    # a ticker has a row for every day, changed or not
    nothing = [F.lit(0).cast("bigint").alias(c) for c in COUNTS]
    days = F.transform(F.sequence(first, last), lambda d: F.struct(d.alias("day"), *nothing))
    return F.concat(moved, point, F.when(prev.isNull(), days).otherwise(F.array()))


def recent_counts(
    prices: DataFrame, last: date | Column, days: int = 30, thresholds: Thresholds = DEFAULTS
) -> DataFrame:
    """(ticker, check_date, counts) as `recent_profile` has them on each of `days` as-of days.

    A difference array over the as-of days: every bar adds to the counts on the day on
    which it enters a check's days and takes away on the day after it leaves them; running
    sums give all days from one windowed frame, with one shuffle.
    """
    t, last_day = thresholds, lit_or_col(last)
    first = F.date_sub(last_day, days - 1)
    source = F.date_sub(first, t.history_days + t.warmup_days)
    # the last day travels as a column: functions over arrays take no subquery
    recent = prices.select("ticker", "date", "close", last_day.alias("last_day")).where(
        (F.col("date") >= source) & (F.col("date") <= last_day)
    )
    ends = F.date_sub("last_day", days - 1), F.col("last_day")
    before = series().rowsBetween(-OUTLIER_ROWS, -1)
    frame = (
        with_z_scores(recent)
        .withColumn("seen", F.collect_list(F.struct("date", "close")).over(before))
        .withColumn("prev_date", F.lag("date").over(series()))
        .withColumn("gap", F.datediff("date", "prev_date"))
    )
    changes = frame.select("ticker", F.inline(_changes_of_bar(*ends, t)))
    by_day = changes.groupBy("ticker", "day").agg(*[F.sum(c).alias(c) for c in COUNTS])
    so_far = Window.partitionBy("ticker").orderBy("day")
    return by_day.select(
        "ticker", F.col("day").alias("check_date"), *[F.sum(c).over(so_far).alias(c) for c in COUNTS]
    )


def _freshness_by_day(prices: DataFrame, last: Column, days: int, hours: int) -> DataFrame:
    """(ticker, check_date, hours_since_ingest) on each day from a ticker's first bar on."""
    first = F.date_sub(last, days - 1)
    known = (
        prices.where(F.col("date") <= last)
        .groupBy("ticker", F.greatest("date", first).alias("day"))
        .agg(F.max("ingested_at").alias("ingested"))
    )
    by_day = Window.partitionBy("ticker").orderBy("day")
    until = F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), last)
    filled = known.select(
        "ticker", "day", F.max("ingested").over(by_day).alias("last_ingested"), until.alias("until")
    ).select("ticker", "last_ingested", F.explode(F.sequence("day", "until")).alias("check_date"))
    return filled.select(
        "ticker",
        "check_date",
        whole_hours(F.col("last_ingested"), _checked_at(hours)).alias("hours_since_ingest"),
    )


def _checked_at(hours: int) -> Column:
    return F.col("check_date").cast("timestamp") + F.expr(f"INTERVAL {int(hours)} HOURS")


def quality_history(
    prices: DataFrame,
    last: date | Column,
    days: int = 30,
    hours: int = 38,
    thresholds: Thresholds = DEFAULTS,
) -> DataFrame:
    """(check_date, ticker, check_name, score, checked_at) of the `days` days up to `last`.

    Each day's scores are those that `quality_scores` gives for the bars known by then, when
    it runs `hours` after the day began. All days share one windowed frame of the recent
    bars; freshness reads two columns of the whole history.
    """
    t = thresholds

    def scored(profile: DataFrame, checks: list[Check]) -> DataFrame:
        entries = [
            F.when(c.applies, F.struct(F.lit(c.name).alias("check_name"), c.score.alias("score")))
            for c in checks
        ]
        kept = F.explode(F.array_compact(F.array(*entries)))
        return profile.select("check_date", "ticker", kept.alias("check"))

    fresh = scored(_freshness_by_day(prices, lit_or_col(last), days, hours), [_freshness(t)])
    recent = scored(recent_counts(prices, last, days, t), [_completeness(t), _outliers(), _gaps()])
    return fresh.unionByName(recent).select(
        "check_date", "ticker", "check.*", _checked_at(hours).alias("checked_at")
    )


# -- reports over stored scores ------------------------------------------------


def _of_day(scores: DataFrame, as_of) -> DataFrame:
    return scores.where(F.col("check_date") == lit_or_col(as_of))


def quality_count(scores: DataFrame, as_of: date | Column) -> DataFrame:
    return _of_day(scores, as_of).groupBy("check_date").agg(F.count(F.lit(1)).alias("scores"))


def quality_summary(scores: DataFrame, as_of: date | Column) -> DataFrame:
    """Mean, worst and failing checks per ticker, weakest first."""
    failing = F.collect_list(F.when(F.col("score") < FAILING, F.col("check_name")))
    return (
        _of_day(scores, as_of)
        .groupBy("ticker")
        .agg(
            F.round(F.avg("score"), 3).alias("overall_health_score"),
            F.min("score").alias("worst_check_score"),
            F.concat_ws(", ", F.array_sort(failing)).alias("failing_checks"),
        )
        .orderBy("overall_health_score", "ticker")
    )


def quality_heatmap_worst(scores: DataFrame, as_of: date | Column, worst: int = 40) -> DataFrame:
    """All checks of the weakest tickers."""
    today = _of_day(scores, as_of)
    # integer sums make equal means compare equal, whatever order they were added in
    tenths = F.sum(F.round(F.col("score") * 10, 0).cast("bigint"))
    weakest = (
        today.groupBy("ticker")
        .agg(F.min("score").alias("low"), (tenths / F.count(F.lit(1))).alias("mean"))
        .orderBy("low", "mean", "ticker")
        .limit(worst)
        .select("ticker")
    )
    return today.join(F.broadcast(weakest), "ticker", "left_semi").orderBy("ticker", "check_name")


def quality_trend(scores: DataFrame, as_of: date | Column, days: int = 30) -> DataFrame:
    return (
        scores.where(F.col("check_date") >= F.date_sub(lit_or_col(as_of), days))
        .groupBy("check_date", "check_name")
        .agg(
            F.round(F.avg("score"), 3).alias("avg_score"),
            F.min("score").alias("min_score"),
            F.count_if(F.col("score") < FAILING).alias("tickers_below_threshold"),
        )
        .orderBy("check_date", "check_name")
    )


def tickers_needing_attention(
    scores: DataFrame, as_of: date | Column, limit: int = 100
) -> DataFrame:
    failing = _of_day(scores, as_of).where(F.col("score") < FAILING)
    return failing.orderBy("score", "ticker", "check_name").limit(limit)
