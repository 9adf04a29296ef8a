"""Demand forecasts of many monthly series at once: windows and group-bys by series, no Python per series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.operators.bi import centred_average, interpolated
from tamiz.operators.stage import staged

# Fixed values.
MODELS = ["naive_estacional", "nivel_estacional_12m", "nivel_estacional_6m", "tendencia_total", "tendencia_24m", "promedio_movil_12m"]
Z = {0.90: 1.2816, 0.95: 1.6449, 0.975: 1.9600, 0.99: 2.3263}


def positions(df: DataFrame) -> DataFrame:
    """``t``: months since the series began, from 1; ``n``: its last."""
    span = df.groupBy("series_id").agg(F.min("month").alias("_a"), F.max("month").alias("_b"))
    t = lambda x: F.months_between(x, F.col("_a")).cast("int") + 1
    return df.join(span, "series_id").withColumns({"t": t(F.col("month")), "n": t(F.col("_b"))}).drop("_a", "_b")


def calendar(df: DataFrame) -> DataFrame:
    """Every month of each series, with a null y where it is missing."""
    span = df.groupBy("series_id").agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = span.select("series_id", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return positions(months.join(df, ["series_id", "month"], "left"))


def seasonal_index(df: DataFrame, y: str = "y") -> DataFrame:
    """(series_id, m, factor) for the twelve months: y over its centred average, by month, with mean 1."""
    ratio = df.select("series_id", F.month("month").alias("m"), F.try_divide(F.col(y), centred_average("series_id", F.col("t"), F.col(y))).alias("r"))
    means = ratio.where("r is not null").groupBy("series_id", "m").agg(F.avg("r").alias("f"))
    every = df.select("series_id").distinct().select("series_id", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    filled = every.join(means, ["series_id", "m"], "left").withColumn("f", F.coalesce("f", F.lit(1.0)))
    return filled.select("series_id", "m", (F.col("f") / F.avg("f").over(Window.partitionBy("series_id"))).alias("factor"))


def completed(df: DataFrame) -> DataFrame:
    """A staged table. Missing months get the local level times the month's factor, and ``imputed``."""
    full = interpolated(calendar(staged(df)), "series_id", F.col("t"), "y", "_p")
    factors = seasonal_index(full, "_p")
    level = full.withColumn("m", F.month("month")).join(factors, ["series_id", "m"]).withColumn("_level", F.col("y") / F.col("factor"))
    level = interpolated(level, "series_id", F.col("t"), "_level", "_l2")
    done = level.select("series_id", "month", "t", "n", F.coalesce("y", F.col("_l2") * F.col("factor")).alias("y"), F.col("y").isNull().alias("imputed"))
    return staged(done)  # models, backtest and selection each read it several times


def _future(train: DataFrame, horizon: int) -> DataFrame:
    ends = train.groupBy("series_id").agg(F.max("month").alias("_last"), F.max("t").alias("_n"))
    steps = ends.select("series_id", "_last", "_n", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    return steps.select("series_id", F.add_months("_last", F.col("h")).alias("month"), (F.col("_n") + F.col("h")).alias("t"), F.month(F.add_months("_last", F.col("h"))).alias("m"))


def predictions(train: DataFrame, horizon: int) -> DataFrame:
    """(series_id, month, model, p): every model over the ``horizon`` months after each series' end.

    ``train`` has t from 1 without gaps. All models come from one row of statistics a series.
    """
    factors = seasonal_index(train)
    bare = train.withColumn("m", F.month("month")).join(factors, ["series_id", "m"]).withColumn("d", F.col("y") / F.col("factor"))
    bare = bare.withColumn("back", F.max("t").over(Window.partitionBy("series_id")) - F.col("t"))
    within = lambda c, k: F.when(F.col("back") < k, F.col(c))
    stats = bare.groupBy("series_id").agg(
        F.avg(within("y", 12)).alias("mean12"), F.avg(within("d", 12)).alias("level12"), F.avg(within("d", 6)).alias("level6"),
        F.regr_slope("d", F.col("t").cast("double")).alias("slope"), F.regr_intercept("d", F.col("t").cast("double")).alias("intercept"),
        F.regr_slope(within("d", 24), F.col("t").cast("double")).alias("slope24"), F.regr_intercept(within("d", 24), F.col("t").cast("double")).alias("intercept24"))
    ago = train.select("series_id", F.add_months("month", 12).alias("month"), F.col("y").alias("ago"))
    rows = _future(train, horizon).join(factors, ["series_id", "m"]).join(stats, "series_id").join(ago, ["series_id", "month"], "left")
    f, t = F.col("factor"), F.col("t")
    values = [F.coalesce("ago", "mean12"), F.col("level12") * f, F.col("level6") * f, (F.col("intercept") + F.col("slope") * t) * f, (F.col("intercept24") + F.col("slope24") * t) * f, F.col("mean12")]
    models = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(name).alias("model"), v.alias("p")) for k, (name, v) in enumerate(zip(MODELS, values))])
    return rows.select("series_id", "month", F.explode(models).alias("x")).select("series_id", "month", "x.k", "x.model", "x.p")


def mape(actual: DataFrame, predicted: DataFrame, *keys: str) -> DataFrame:
    """Mean absolute error in % over the months both have, where the actual isn't 0."""
    both = actual.join(predicted, ["series_id", "month"]).where("y <> 0")
    return both.groupBy("series_id", *keys).agg((F.avg(F.abs(F.col("y") - F.col("p")) / F.abs("y")) * 100).alias("mape"))


def backtest(full: DataFrame, holdout: int = 12) -> DataFrame:
    """(series_id, k, model, mape, residual_std) of series long enough to hold months out."""
    long = full.where(F.col("n") >= holdout + 13)
    train, held = long.where(F.col("t") <= F.col("n") - holdout), long.where(F.col("t") > F.col("n") - holdout).select("series_id", "month", "y")
    both = held.join(predictions(train, holdout), ["series_id", "month"])  # joined once for both figures
    error = F.col("y") - F.col("p")
    share = F.avg(F.when(F.col("y") != 0, F.abs(error) / F.abs("y"))) * 100
    return both.groupBy("series_id", "k", "model").agg(F.round(share, 2).alias("mape"), F.stddev_samp(error).alias("residual_std")).where("mape is not null")


def selected(full: DataFrame, holdout: int = 12, force: str | None = None) -> DataFrame:
    """(series_id, model, mape, residual_std): the least error, ties by the order of MODELS; short series are seasonal naive."""
    scored = backtest(full, holdout)
    if force:
        best = scored.where(F.col("model") == force)
    else:
        rank = F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("mape").asc_nulls_last(), "k"))
        best = scored.withColumn("_r", rank).where("_r = 1")
    every = full.select("series_id").distinct()
    return every.join(best.select("series_id", "model", "mape", "residual_std"), "series_id", "left").withColumn("model", F.coalesce("model", F.lit(MODELS[0])))


def forecast(full: DataFrame, horizon: int = 12, holdout: int = 12, force: str | None = None) -> DataFrame:
    """(series_id, month, model, p): each series' own model, refitted on all of its months."""
    return predictions(full, horizon).join(selected(full, holdout, force).select("series_id", "model"), ["series_id", "model"]).select("series_id", "month", "model", "p")


def safety_stock(df: DataFrame, value: str, level: float = 0.95, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg((F.coalesce(F.stddev_samp(value), F.lit(0.0)) * Z.get(round(level, 3), 1.6449)).alias("safety_stock"))


def purchase_plan(monthly: DataFrame, level: float = 0.95) -> DataFrame:
    """Units to buy a series for the next year: last year's, scaled to twelve months and by the forecast's
    growth, and the safety stock; with its share of all and the month's order."""
    full = completed(monthly)
    recent = full.where(F.col("n") - F.col("t") < 12).groupBy("series_id").agg(F.sum("y").alias("last_year"), F.count("*").alias("months"))
    ahead = forecast(full).groupBy("series_id").agg(F.sum("p").alias("ahead"))
    stock = safety_stock(full, "y", level, "series_id")
    plan = recent.join(ahead, "series_id").join(stock, "series_id")
    growth = F.when(F.col("last_year") != 0, F.col("ahead") / F.col("last_year") - 1).otherwise(0.0)
    plan = plan.withColumn("units", F.col("last_year") * 12 / F.col("months") * (1 + growth) + F.col("safety_stock"))
    total = plan.agg(F.sum("units").alias("_all"))
    return plan.crossJoin(F.broadcast(total)).select("series_id", F.round("units", 4).alias("units"), F.round(F.col("units") / F.col("_all") * 100, 4).alias("share"), F.round(F.col("units") / 12, 4).alias("monthly_order"))
