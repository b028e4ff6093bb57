"""The metric set day by day: a state per ticker that new bars advance.

A run over all history reads every bar again. A state keeps what the measures need
instead: the first and last bar, the running peak and worst fall, count, mean and
squared deviations of the returns, and the lowest returns. `advance` reads the states
and the new bars only, in one shuffle by ticker.

The lowest returns are all those up to a cut, about twice as many as the 5 % quantile
needs, so nothing that a later quantile needs has been forgotten while the tail is long
enough. Returns above the cut are only counted. Two cases can't be advanced and mark the
state `stale`: a bar that is not later than the state, and a tail that has become too
short for the grown count. `rebuild` reads the bars of just those tickers again.

Closes are not negative, as the table constraint demands. A ticker's tail and its new
bars are bounded by its days, see `returns`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import (
    INFINITY,
    PRECISION,
    TRADING_DAYS,
    annualized,
    as_loss,
    ieee_ratio,
    is_finite,
    rounded,
)
from barloom.operators.returns import so_far, with_returns
from barloom.operators.risk import FLAT, MIN_POINTS, RISK_FREE, TAIL
from barloom.schemas import METRIC_COLUMNS

WIDEST = max(TAIL.values())
SLACK = 2  # how many times the values that the widest quantile needs a trimmed tail keeps

STATE = (
    "ticker string, window_start date, window_end date, points bigint, last_close double, "
    "peak double, fall double, returns bigint, mean double, deviations double, "
    "cut double, tail array<double>, stale boolean"
)


def _needed(returns: Column) -> Column:
    """How many of the lowest returns the widest quantile looks at."""
    return (F.floor((returns - 1) * F.lit(WIDEST)) + 2).cast("int")


def empty_state(prices: DataFrame) -> DataFrame:
    return prices.sparkSession.createDataFrame([], STATE)


def metric_state(prices: DataFrame) -> DataFrame:
    """The state after all given bars."""
    return advance(empty_state(prices), prices)


def advance(state: DataFrame, bars: DataFrame) -> DataFrame:
    """The states after the bars of further days; tickers without new bars keep theirs.

    A ticker without a state gets one. Bars that are not later than their ticker's state
    make it stale.
    """
    fields = [name for name in state.columns if name != "ticker"]
    before = state.select(
        "ticker",
        F.col("window_end").alias("date"),
        F.col("last_close").alias("close"),
        F.struct(*fields).alias("old"),
    )
    new = bars.select("ticker", "date", F.col("close").cast("double").alias("close"))
    rows = with_returns(before.unionByName(new, allowMissingColumns=True))

    is_new = F.col("old").isNull()
    peak = F.max(F.coalesce(F.col("old.peak"), F.col("close"))).over(so_far())
    known_until = F.max("old.window_end").over(Window.partitionBy("ticker"))
    cut = F.max("old.cut").over(Window.partitionBy("ticker"))
    defined = is_new & ~F.isnan("daily_return")
    rows = (
        rows.withColumn("running_peak", peak)
        .withColumn("late", is_new & (F.col("date") <= known_until))
        .withColumn("cut", F.coalesce(cut, F.lit(INFINITY)))
        .withColumn("r", F.when(defined, F.col("daily_return")))
        .withColumn(
            "drawdown", ieee_ratio(F.col("running_peak") - F.col("close"), F.col("running_peak"))
        )
    )
    low = F.col("r") <= F.col("cut")
    gathered = rows.groupBy("ticker").agg(
        F.first("old", ignorenulls=True).alias("old"),
        F.min(F.when(is_new, F.col("date"))).alias("from"),
        F.max("date").alias("until"),
        F.count_if(is_new).alias("bars"),
        F.max_by("close", "date").alias("last_close"),
        F.max("running_peak").alias("peak"),
        F.max(F.when(is_new & ~F.isnan("drawdown"), F.col("drawdown"))).alias("new_fall"),
        F.count("r").alias("n"),
        F.avg("r").alias("avg"),
        (F.var_pop("r") * F.count("r")).alias("m2"),
        F.max("cut").alias("cut"),
        F.collect_list(F.when(low, F.col("r"))).alias("lows"),
        F.bool_or("late").alias("late"),
    )
    return _trimmed(_merged(gathered))


def _merged(gathered: DataFrame) -> DataFrame:
    """Old moments and those of the new bars as one."""
    zero, nothing = F.lit(0).cast("bigint"), F.array().cast("array<double>")
    n1, n2 = F.coalesce("old.returns", zero), F.col("n")
    total = n1 + n2
    step = F.col("avg") - F.col("old.mean")
    both = (n1 > 0) & (n2 > 0)
    mean = F.when(both, F.col("old.mean") + step * n2 / total)
    spread = F.when(both, F.col("old.deviations") + F.col("m2") + step * step * (n1 * n2 / total))
    return gathered.select(
        "ticker",
        F.coalesce("old.window_start", "from").alias("window_start"),
        F.col("until").alias("window_end"),
        (F.coalesce("old.points", zero) + F.col("bars")).alias("points"),
        "last_close",
        "peak",
        F.greatest("old.fall", "new_fall").alias("fall"),
        total.alias("returns"),
        F.coalesce(mean, F.when(n2 > 0, F.col("avg")), F.col("old.mean")).alias("mean"),
        F.coalesce(spread, F.when(n2 > 0, F.col("m2")), F.col("old.deviations")).alias("deviations"),
        "cut",
        F.array_sort(F.concat(F.coalesce("old.tail", nothing), "lows")).alias("tail"),
        (F.coalesce("old.stale", F.lit(False)) | F.coalesce("late", F.lit(False))).alias("stale"),
    )


def _trimmed(state: DataFrame) -> DataFrame:
    """Long tails shortened to the lowest values and their ties; too short ones marked."""
    keep = F.lit(SLACK) * _needed(F.col("returns"))
    long = F.size("tail") > F.lit(2) * keep
    cut = F.when(long, F.get("tail", keep - 1)).otherwise(F.col("cut"))
    short = (F.col("cut") < INFINITY) & (F.size("tail") < _needed(F.col("returns")))
    return state.withColumn("cut", cut).withColumn(
        "tail", F.filter("tail", lambda r: r <= F.col("cut"))
    ).withColumn("stale", F.col("stale") | short)


def rebuild(state: DataFrame, prices: DataFrame) -> DataFrame:
    """Stale states computed anew from all bars of their tickers, the others unchanged."""
    stale = state.where("stale").select("ticker")
    again = metric_state(prices.join(stale, "ticker", "left_semi"))
    return state.where(~F.col("stale")).unionByName(again)


def _quantile(share: float) -> Column:
    """The interpolated quantile of all returns, from their lowest."""
    rank = (F.col("returns") - 1) * F.lit(share)
    low, high = F.floor(rank).cast("int"), F.ceil(rank).cast("int")
    between = (high - rank) * F.get("tail", low) + (rank - low) * F.get("tail", high)
    value = F.when(low == high, F.get("tail", low)).otherwise(between)
    return F.when(F.col("returns") > 0, value)


def _tail_mean(quantile: str) -> Column:
    lows = F.filter("tail", lambda r: r <= F.col(quantile))
    total = F.aggregate(lows, F.lit(0.0), lambda held, r: held + r)
    return F.try_divide(total, F.size(lows).cast("double"))


def metrics_from_state(
    state: DataFrame,
    min_points: int = MIN_POINTS,
    risk_free_rate: float = RISK_FREE,
    digits: int | None = PRECISION,
) -> DataFrame:
    """As `risk.risk_metrics` over all bars that the states have seen.

    A stale state is an error: `rebuild` comes first.
    """
    n = F.col("returns")
    unusable = F.raise_error(F.concat(F.lit("stale metric state of "), F.col("ticker")))
    yearly = F.col("volatility")
    excess = F.col("mean") - F.lit(risk_free_rate / TRADING_DAYS)
    sets = state.where(F.col("points") >= min_points).withColumn(
        "deviation", F.sqrt(F.try_divide(F.col("deviations"), (n - 1).cast("double")))
    )
    sets = sets.withColumn("volatility", annualized(F.col("deviation")))
    for name, share in TAIL.items():
        sets = sets.withColumn(f"q_{name}", _quantile(share))
    measures = {
        "annualized_volatility": F.when(yearly < FLAT, F.lit(0.0)).otherwise(yearly),
        **{f"var_{name}": as_loss(F.col(f"q_{name}")) for name in TAIL},
        **{
            f"cvar_{name}": F.coalesce(as_loss(_tail_mean(f"q_{name}")), F.lit(0.0))
            for name in TAIL
        },
        "sharpe_ratio": F.when(
            F.coalesce(F.col("deviation") < FLAT, n == 0), F.lit(0.0)
        ).otherwise(annualized(F.try_divide(excess, F.col("deviation")))),
        "max_drawdown": F.when(F.col("stale"), unusable.cast("double")).otherwise(F.col("fall")),
    }
    # the finite sets come out of a generator: as a filter the check would be pushed down
    # and every measure's expression repeated once per use
    values = F.array(*[measures[name] for name in METRIC_COLUMNS])
    finite = F.filter(F.array(values), lambda found: F.forall(found, is_finite))
    sets = sets.select("ticker", "window_start", "window_end", F.explode(finite).alias("found"))
    return sets.select(
        "ticker",
        "window_start",
        "window_end",
        *[
            (F.col("found")[i] if digits is None else rounded(F.col("found")[i], digits)).alias(name)
            for i, name in enumerate(METRIC_COLUMNS)
        ],
    )
