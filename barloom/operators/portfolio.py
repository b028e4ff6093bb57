"""Portfolio definitions and portfolio risk.

holdings(portfolio, ticker, weight) has one row per portfolio and ticker.
A ticker can be in most portfolios and a portfolio can hold most tickers. Group
totals are aggregated partially and joined back. A ticker's returns are packed by
year, each year with its moments and a bitmap of its days; holdings meet moments and bitmaps.
The days on which a portfolio is complete are the conjunction of bitmaps. Portfolios are
dealt into blocks; a packed year is sent once to every block that holds its ticker, not with
every holding, and only complete days are expanded, where their portfolio is. All that
follows by portfolio stays in its block, so no day is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import PRECISION, annualized, as_loss, ieee_ratio, rounded, symbol
from barloom.operators.mutate import delete_keys
from barloom.operators.returns import series, so_far, with_returns
from barloom.operators.risk import MIN_POINTS, RISK_FREE, TAIL, cvar_of, sharpe_of, worst_fall
from barloom.operators.universe import check_page
from barloom.schemas import HOLDING_KEY, METRIC_COLUMNS

NAME_LIMIT = 100
BUCKET_SLOTS = 256  # returns of one ticker in one array, by position
WORD_BITS, WORDS = 62, 6  # bitmaps of a bucket's slots: at least 366 bits
BLOCKS = 256  # portfolios are dealt into so many, each a task

# -- definitions ---------------------------------------------------------------


def with_group_totals(rows: DataFrame, key: str, totals: dict[str, Column]) -> DataFrame:
    """Rows with aggregates of their group, which no task ever holds as a whole."""
    grouped = rows.groupBy(key).agg(*[total.alias(name) for name, total in totals.items()])
    return rows.join(grouped, key)


def normalize_weights(holdings: DataFrame) -> DataFrame:
    """Weights of each portfolio scaled to sum to 1."""
    return with_group_totals(holdings, "portfolio", {"_total": F.sum("weight")}).select(
        "portfolio", "ticker", (F.col("weight") / F.col("_total")).alias("weight")
    )


def request_legs(requests: DataFrame) -> DataFrame:
    """requests(portfolio, ticker, weight), a NULL ticker meaning a request without holdings."""
    return requests.where(F.col("ticker").isNotNull()).select(
        "portfolio", symbol("ticker").alias("ticker"), "weight"
    )


def _refusals(requests: DataFrame, known: DataFrame) -> DataFrame:
    """(portfolio, found, reasons) of every requested portfolio; found: it is among `known`."""
    legs = requests.withColumn("ticker", symbol("ticker"))
    per_ticker = legs.groupBy("portfolio", "ticker").agg(
        F.count("ticker").alias("times"),
        F.count_if(F.coalesce(F.col("weight") <= 0, F.col("ticker").isNotNull())).alias("bad"),
    )
    facts = per_ticker.groupBy("portfolio").agg(
        F.sum("times").alias("legs"), F.max("times").alias("most"), F.sum("bad").alias("bad")
    )
    stored = known.select("portfolio").distinct().withColumn("stored", F.lit(True))
    reasons = F.array(
        F.when(F.col("most") > 1, F.lit("duplicate_ticker")),
        F.when(F.col("bad") > 0, F.lit("bad_weight")),
        F.when(F.col("legs") == 0, F.lit("empty")),
        F.when(F.length("portfolio") > NAME_LIMIT, F.lit("name_too_long")),
    )
    return facts.join(stored, "portfolio", "left").select(
        "portfolio",
        F.coalesce("stored", F.lit(False)).alias("found"),
        F.array_compact(reasons).alias("reasons"),
    )


def _listed_reasons(refusals: DataFrame, own: Column) -> DataFrame:
    reasons = F.array_compact(F.array_append("reasons", own))
    return refusals.select("portfolio", F.explode(reasons).alias("reason"))


def portfolio_conflicts(existing: DataFrame, requests: DataFrame) -> DataFrame:
    """Why a portfolio to be created is refused, one row per portfolio and reason."""
    return _listed_reasons(_refusals(requests, existing), F.when(F.col("found"), F.lit("exists")))


def replacement_conflicts(existing: DataFrame, replacement: DataFrame) -> DataFrame:
    """Why holdings to be replaced are refused, one row per portfolio and reason."""
    unknown = F.when(~F.col("found"), F.lit("unknown"))
    return _listed_reasons(_refusals(replacement, existing), unknown)


def create_portfolios(existing: DataFrame, requests: DataFrame) -> DataFrame:
    """Normalised holdings of the requests that are accepted."""
    refused = portfolio_conflicts(existing, requests).select("portfolio").distinct()
    accepted = request_legs(requests).join(refused, "portfolio", "left_anti")
    return normalize_weights(accepted)


def replace_holdings(holdings: DataFrame, replacement: DataFrame) -> DataFrame:
    """Drop all holdings of the replaced portfolios and insert the new ones, normalised.

    Replacements that `replacement_conflicts` refuses change nothing: no holdings, a
    weight that is not positive, a ticker twice, a portfolio that holds nothing yet.
    """
    refused = replacement_conflicts(holdings, replacement).select("portfolio").distinct()
    accepted = replacement.join(refused, "portfolio", "left_anti")
    kept = delete_keys(holdings, accepted.select("portfolio").distinct(), ["portfolio"])
    fresh = normalize_weights(request_legs(accepted))
    return kept.unionByName(fresh.select(*holdings.columns))


def delete_portfolios(
    portfolios: DataFrame, holdings: DataFrame, doomed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Portfolios and, with them, their holdings."""
    return (
        delete_keys(portfolios, doomed, ["portfolio"]),
        delete_keys(holdings, doomed, ["portfolio"]),
    )


def by_name(portfolios: DataFrame) -> DataFrame:
    """Stored portfolios, their name as the key of their holdings."""
    return portfolios.withColumnRenamed("name", "portfolio")


def _with_holdings(page: DataFrame, holdings: DataFrame) -> DataFrame:
    """A page of portfolios with the holdings of each as a sorted array; only theirs are gathered."""
    held = F.array_sort(F.collect_list(F.struct("ticker", "weight")))
    of_page = holdings.join(F.broadcast(page.select("portfolio")), "portfolio", "left_semi")
    legs = of_page.groupBy("portfolio").agg(held.alias("holdings"))
    none = F.array().cast("array<struct<ticker:string,weight:double>>")
    return page.join(legs, "portfolio", "left").withColumn("holdings", F.coalesce("holdings", none))


def portfolio_list(
    portfolios: DataFrame, holdings: DataFrame, limit: int = 50, offset: int = 0
) -> DataFrame:
    """A page of portfolios, each with its holdings as a sorted array.

    The page is cut first, so only its portfolios' holdings are gathered.
    """
    check_page(limit, offset, 500)
    page = portfolios.select("portfolio").orderBy("portfolio").offset(offset).limit(limit)
    return _with_holdings(page, holdings)


def portfolio_page(
    portfolios: DataFrame, holdings: DataFrame, limit: int = 50, offset: int = 0
) -> DataFrame:
    """A page of stored portfolios in the order of their creation, then name: portfolio_id, name,
    created_at, updated_at and the holdings as a sorted array."""
    check_page(limit, offset, 500)
    ordered = by_name(portfolios).orderBy("created_at", "portfolio").offset(offset).limit(limit)
    return _with_holdings(ordered, holdings).select(
        "portfolio_id", F.col("portfolio").alias("name"), "created_at", "updated_at", "holdings"
    )


# -- risk ----------------------------------------------------------------------


def _returns(prices: DataFrame, align: str) -> DataFrame:
    """(ticker, bucket, slot, bit, daily_return) of tickers with enough bars.

    slot is the date, or the return's number counted from the ticker's oldest; bit is its
    number within the bucket, a year or BUCKET_SLOTS numbers.
    """
    if align not in ("date", "position"):
        raise ValueError(f"unknown alignment: {align}")
    bars = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    dated = align == "date"
    slot = F.col("date") if dated else F.row_number().over(series()) - 1
    bucket = F.year("slot") if dated else F.floor(F.col("slot") / BUCKET_SLOTS)
    bit = F.dayofyear("slot") - 1 if dated else (F.col("slot") % BUCKET_SLOTS).cast("int")
    return (
        with_returns(prices.select("ticker", "date", "close"))
        .withColumn("slot", slot)
        .withColumn("bars", bars)
        .where((F.col("bars") >= MIN_POINTS) & F.col("prev_close").isNotNull())
        .select("ticker", bucket.alias("bucket"), "slot", bit.alias("bit"), "daily_return")
    )


def _packed(returns: DataFrame) -> DataFrame:
    """One row per ticker and bucket: its returns as an array, the moments n, s and q
    (count, sum, sum of squares), and a bitmap of the slots that have one.

    A bucket has 366 slots at most. Without a usable return there is no row.
    """
    r, word = F.col("daily_return"), F.floor(F.col("bit") / WORD_BITS)
    flag = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit") % WORD_BITS)
    words = [F.coalesce(F.bit_or(F.when(word == k, flag)), F.lit(0).cast("bigint")) for k in range(WORDS)]
    return (
        returns.where(~F.isnan("daily_return"))
        .groupBy("ticker", "bucket")
        .agg(
            F.collect_list(F.struct("slot", "bit", "daily_return")).alias("returns"),
            F.count(r).alias("n"),
            F.sum(r).alias("s"),
            F.sum(r * r).alias("q"),
            *[w.alias(f"has_{k}") for k, w in enumerate(words)],
        )
    )


def _legs(prices: DataFrame, holdings: DataFrame, align: str) -> DataFrame:
    """Every holding in every bucket in which its portfolio has complete slots, in the
    portfolio's block; `year` is the ticker's packed bucket.

    all_* is the bitmap of the slots at which no holding is missing, the conjunction of the
    holdings' own bitmaps; nothing is expanded to find it.
    """
    returns = _returns(prices, align)
    packed = _packed(returns)
    # a ticker whose returns are all unusable counts as a holding that is always missing
    held = holdings.select(*HOLDING_KEY, "weight").join(
        returns.select("ticker").distinct(), "ticker", "left_semi"
    )
    counted = with_group_totals(held, "portfolio", {"needed": F.count(F.lit(1))})
    legs = counted.join(packed.drop("returns", "n", "s", "q"), "ticker")
    complete = (
        legs.groupBy("portfolio", "bucket")
        .agg(
            F.count(F.lit(1)).alias("legs"),
            F.max("needed").alias("needed"),
            *[F.bit_and(f"has_{k}").alias(f"all_{k}") for k in range(WORDS)],
        )
        .where(F.col("legs") == F.col("needed"))
        .select("portfolio", "bucket", *[f"all_{k}" for k in range(WORDS)])
    )
    return _with_years(legs.join(complete, ["portfolio", "bucket"]), packed, held)


def _with_years(legs: DataFrame, packed: DataFrame, held: DataFrame) -> DataFrame:
    """Legs in their portfolio's block with their ticker's packed bucket.

    Legs and a copy of the packed buckets for every block go through one shuffle by block; within
    it a packed row precedes the legs of its ticker, which take it over as they pass.
    """
    block = F.pmod(F.xxhash64("portfolio"), F.lit(BLOCKS)).cast("int").alias("block")
    facts = ["returns", "n", "s", "q", *[f"has_{k}" for k in range(WORDS)]]
    copies = packed.join(held.select(block, "ticker").distinct(), "ticker").select(
        "block", "bucket", "ticker", F.struct(*facts).alias("year")
    )
    own = legs.select(
        block, "bucket", *HOLDING_KEY, "weight", *[f"all_{k}" for k in range(WORDS)], F.lit(True).alias("leg")
    )
    met = Window.partitionBy("block", "bucket", "ticker").orderBy(F.asc_nulls_first("leg"))
    so_far_met = met.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        own.unionByName(copies, allowMissingColumns=True)
        .repartitionById(BLOCKS, "block")
        .withColumn("year", F.first("year").over(so_far_met))
        .where("leg")
        .drop("leg")
    )


def _whole() -> Column:
    """Whether a leg's bucket has complete slots only."""
    whole = F.lit(True)
    for k in range(WORDS):
        whole = whole & (F.col(f"all_{k}") == F.col(f"year.has_{k}"))
    return whole


def _complete_returns() -> Column:
    """A leg's returns at its portfolio's complete slots."""
    words = F.array(*[F.col(f"all_{k}") for k in range(WORDS)])

    def complete(x: Column) -> Column:
        word = F.get(words, F.floor(x["bit"] / WORD_BITS).cast("int"))
        return F.call_function("getbit", word, x["bit"] % WORD_BITS) == 1

    return F.when(_whole(), F.col("year.returns")).otherwise(F.filter("year.returns", complete))


def _complete_days(legs: DataFrame) -> DataFrame:
    """(block, portfolio, slot, portfolio_return) of the slots at which no holding is missing.

    The only place where holdings x slots become rows; their sum is taken in their block.
    """
    gain = F.sum(F.col("weight") * F.col("daily_return"))
    return (
        legs.select("block", "portfolio", "weight", F.inline(_complete_returns()))
        .groupBy("block", "portfolio", "slot")
        .agg((gain / F.sum("weight")).alias("portfolio_return"))
    )


def _leg_volatility(legs: DataFrame) -> DataFrame:
    """(portfolio, leg_vol): weighted mean volatility of the holdings over the complete days.

    Moments merge over buckets; where a bucket has all of a ticker's slots they are those of
    the ticker, only in the others they are added up again.
    """
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))

    def add(m: Column, x: Column) -> Column:
        r = x["daily_return"]
        return F.struct((m["n"] + 1).alias("n"), (m["s"] + r).alias("s"), (m["q"] + r * r).alias("q"))

    moments = F.when(_whole(), F.struct("year.n", "year.s", "year.q")).otherwise(
        F.aggregate(_complete_returns(), zero, add)
    )
    n, s, q = F.sum("m.n"), F.sum("m.s"), F.sum("m.q")
    spread = F.greatest(q - F.try_divide(s * s, n), F.lit(0.0))
    return (
        legs.select("block", "portfolio", "ticker", "weight", moments.alias("m"))
        .groupBy("block", "portfolio", "ticker")
        .agg(
            F.max("weight").alias("weight"),
            annualized(F.sqrt(F.try_divide(spread, n - 1))).alias("vol"),
        )
        .groupBy("block", "portfolio")
        .agg(F.try_divide(F.sum(F.col("weight") * F.col("vol")), F.sum("weight")).alias("leg_vol"))
    )


def _slot_name(align: str) -> str:
    return "date" if align == "date" else "position"


def aligned_returns(prices: DataFrame, holdings: DataFrame, align: str = "date") -> DataFrame:
    """Weighted return per portfolio and day, days with a missing leg left out."""
    days = _complete_days(_legs(prices, holdings, align))
    return days.select("portfolio", F.col("slot").alias(_slot_name(align)), "portfolio_return")


def _path(order: str, by: tuple[str, ...] = ("portfolio",)) -> Column:
    return F.product(F.col("portfolio_return") + 1.0).over(so_far([*by], order))


def cumulative_returns(aligned: DataFrame, order: str = "date") -> DataFrame:
    """Compounded growth of each portfolio."""
    return aligned.select("portfolio", order, _path(order).alias("cumulative"))


def portfolio_growth(prices: DataFrame, holdings: DataFrame, align: str = "date") -> DataFrame:
    """`cumulative_returns` of `aligned_returns`, each portfolio compounded in its block."""
    days = _complete_days(_legs(prices, holdings, align))
    path = _path("slot", ("block", "portfolio")).alias("cumulative")
    return days.select("portfolio", F.col("slot").alias(_slot_name(align)), path)


def portfolio_risk(
    prices: DataFrame,
    holdings: DataFrame,
    risk_free_rate: float = RISK_FREE,
    align: str = "date",
    digits: int = PRECISION,
) -> DataFrame:
    """Seven measures and the diversification ratio of each portfolio.

    Portfolios with fewer than three complete days are left out. The ratio is
    the weighted mean of the legs' volatility over the portfolio's own.
    """
    legs = _legs(prices, holdings, align)
    days = _complete_days(legs)
    r = "portfolio_return"
    by = ["block", "portfolio"]
    whole = Window.partitionBy(*by)
    frame = days.withColumn("path", _path("slot", tuple(by)))
    frame = frame.withColumn("peak", F.max("path").over(so_far(by, "slot")))
    frame = frame.withColumn("drawdown", ieee_ratio(F.col("peak") - F.col("path"), F.col("peak")))
    for name, tail in TAIL.items():
        frame = frame.withColumn(f"q_{name}", F.percentile(r, F.lit(tail)).over(whole))
    measures = frame.groupBy(*by).agg(
        F.count(r).alias("days"),
        annualized(F.stddev_samp(r)).alias("annualized_volatility"),
        *[as_loss(F.min(f"q_{n}")).alias(f"var_{n}") for n in TAIL],
        *[cvar_of(f"q_{n}", r).alias(f"cvar_{n}") for n in TAIL],
        sharpe_of(risk_free_rate, 1, r).alias("sharpe_ratio"),
        worst_fall().alias("max_drawdown"),
    ).join(_leg_volatility(legs).drop("block"), "portfolio")
    own = F.col("annualized_volatility")
    ratio = F.when(own > 0, F.try_divide(F.col("leg_vol"), own)).otherwise(F.lit(1.0))
    return (
        measures.where(F.col("days") >= MIN_POINTS)
        .select(
            "portfolio",
            *[rounded(name, digits).alias(name) for name in METRIC_COLUMNS],
            F.round(ratio, 4).alias("diversification_ratio"),
        )
    )
