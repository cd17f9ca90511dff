"""Trend, forecast, growth, smoothing, concentration, correlation.

These run on *aggregated* series (one row per day or per group), never on raw
rows. The position index and the moving average accept ``partition_cols`` so
several series are processed in parallel, and a single series is numbered
and smoothed without a global window (see ``with_position``).

Fits use exact integer sums: the value is scaled to an integer by
``10**scale`` (0 for counts, 2 for published money and averages, 4 for
rates), so n, sum x, sum y, sum xy, sum xx and sum yy are exact on any
partitioning, and the closing arithmetic is a fixed sequence of double
operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import staged

_INT = "decimal(38,0)"

# Trend thresholds on slope / standard deviation, and the
# correlation bands.
TREND_THRESHOLD = 0.05
STRONG_CORRELATION = 0.5
MODERATE_CORRELATION = 0.2


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(c: Column | str, scale: int) -> Column:
    """Exact integer image of a value with at most ``scale`` decimals."""
    return F.round(_c(c).cast("decimal(38,6)") * F.lit(10**scale)).cast(_INT)


# --------------------------------------------------------------------------
# W3 / W2
# --------------------------------------------------------------------------

def with_position(
    series: DataFrame,
    order_col: str,
    partition_cols: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """0-based position of each row in ``order_col`` order (nulls last), in each series of ``partition_cols``.

    The rows are range-partitioned by series and order and written once to the
    shared folder (so calling this runs a job), that their source is read once
    and no task holds a whole series. Partitions are numbered in parallel, each
    series in each of them; what a series has in earlier partitions is added
    where it spans several: at most two such pieces a partition, which bounds
    the broadcast.
    """
    keys = list(partition_cols)
    order = F.col(order_col).asc_nulls_last()
    ranged = series.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], order)
    b = staged(ranged.withColumn("_part", F.spark_partition_id()), "series")
    pieces = b.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if keys:
        spanning = pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("_parts")).where("_parts > 1").drop("_parts")
        pieces = _same_keys(pieces, spanning, keys, "left_semi")
    offsets = pieces.select("_part", *keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = b.withColumn("_rn", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(order)))
    joined = _same_keys(numbered, F.broadcast(offsets), ["_part", *keys], "left")
    return joined.select(*series.columns, (F.coalesce("_offset", F.lit(0)) + F.col("_rn") - 1).alias(name))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which null equals null; the left side's columns stay."""
    renamed = [f"_right_{k}" for k in keys]
    r = right.withColumnsRenamed(dict(zip(keys, renamed, strict=True)))
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, renamed, strict=True)]
    return left.join(r, on, how) if how == "left_semi" else left.join(r, on, how).drop(*renamed)


def moving_average(
    series: DataFrame,
    order_col: str,
    value_col: str,
    window: int = 7,
    partition_cols: Sequence[str] = (),
    name: str = "moving_average",
) -> DataFrame:
    """Trailing mean of the last ``window`` rows, at least one value.

    Each row contributes its value to the ``window`` positions it covers
    (itself and the next ``window - 1``); the mean per covered position is an
    equi-join plus aggregation, so no task holds the whole series.
    """
    keys = list(partition_cols)
    pos = with_position(series, order_col, partition_cols, "_pos")
    contrib = pos.select(
        *keys,
        F.explode(F.sequence(F.col("_pos"), F.col("_pos") + F.lit(window - 1))).alias("_pos"),
        F.col(value_col).alias("_v"),
    )
    means = contrib.groupBy(*keys, "_pos").agg(F.avg("_v").alias(name))
    return _same_keys(pos, means, [*keys, "_pos"], "left").select(*series.columns, name)


# --------------------------------------------------------------------------
# Exact fit parts (aggregate columns) and the closing expressions
# --------------------------------------------------------------------------

def fit_parts(x: Column | str, y: Column | str, scale: int) -> list[Column]:
    """Aggregates for OLS of y on x and the sample deviation of y.

    ``_n`` counts all rows (nulls included, as the positions do); the sums
    run over rows with a value.
    """
    xv, yv = _c(x), _c(y)
    valid = yv.isNotNull()
    xi = F.when(valid, xv.cast(_INT))
    yi = scaled(yv, scale)
    return [
        F.count(F.lit(1)).alias("_n"),
        F.count(yv).alias("_k"),
        F.sum(xi).alias("_sx"),
        F.sum(yi).alias("_sy"),
        F.sum(xi * xi).alias("_sxx"),
        F.sum(xi * yi).alias("_sxy"),
        F.sum(yi * yi).alias("_syy"),
    ]


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def slope_expr(scale: int) -> Column:
    """T1 slope; 0.0 with fewer than two values."""
    num = F.col("_k") * F.col("_sxy") - F.col("_sx") * F.col("_sy")
    den = F.col("_k") * F.col("_sxx") - F.col("_sx") * F.col("_sx")
    slope = num.cast("double") / den.cast("double") / F.lit(float(10**scale))
    return F.when((F.col("_k") >= 2) & (den != 0), slope).otherwise(F.lit(0.0))


def intercept_expr(scale: int) -> Column:
    mean_y = _d("_sy") / F.lit(float(10**scale)) / _d("_k")
    mean_x = _d("_sx") / _d("_k")
    return F.when(F.col("_k") >= 2, mean_y - slope_expr(scale) * mean_x).otherwise(F.lit(0.0))


def std_expr(scale: int) -> Column:
    """Sample standard deviation of the values (null below two values)."""
    num = F.col("_k") * F.col("_syy") - F.col("_sy") * F.col("_sy")
    den = F.col("_k") * (F.col("_k") - 1)
    var = num.cast("double") / den.cast("double")
    return F.when(F.col("_k") >= 2, F.sqrt(var) / F.lit(float(10**scale)))


def trend_expr(scale: int) -> Column:
    """T4: increasing / decreasing / stable from slope / std."""
    std = std_expr(scale)
    normalized = slope_expr(scale) / std
    return (
        F.when((F.col("_n") < 3) | std.isNull() | (std == 0), F.lit("stable"))
        .when(normalized > TREND_THRESHOLD, F.lit("increasing"))
        .when(normalized < -TREND_THRESHOLD, F.lit("decreasing"))
        .otherwise(F.lit("stable"))
    )


def growth_parts(order: Column | str, y: Column | str) -> list[Column]:
    """First and last non-null value in ``order`` order."""
    yv = _c(y)
    o = F.when(yv.isNotNull(), _c(order))
    return [
        F.min_by(yv, o).cast("double").alias("_first"),
        F.max_by(yv, o).cast("double").alias("_last"),
        F.count(yv).alias("_gk"),
    ]


def growth_expr() -> Column:
    """(last - first) / |first|; 0 with <2 values or a zero end."""
    first, last = F.col("_first"), F.col("_last")
    return F.when(
        (F.col("_gk") >= 2) & (first != 0) & (last != 0), (last - first) / F.abs(first)
    ).otherwise(F.lit(0.0))


def corr_parts(x: Column | str, y: Column | str, scale: int) -> list[Column]:
    """Pairwise-complete sums for Pearson correlation."""
    xv, yv = _c(x), _c(y)
    both = xv.isNotNull() & yv.isNotNull()
    xi = F.when(both, scaled(xv, scale))
    yi = F.when(both, scaled(yv, scale))
    return [
        F.count(F.lit(1)).alias("_cn"),
        F.count(xi).alias("_ck"),
        F.sum(xi).alias("_cx"),
        F.sum(yi).alias("_cy"),
        F.sum(xi * xi).alias("_cxx"),
        F.sum(yi * yi).alias("_cyy"),
        F.sum(xi * yi).alias("_cxy"),
    ]


def corr_expr() -> Column:
    """Pearson r; 0.0 when the table has at most 2 rows, null if constant."""
    k = F.col("_ck")
    num = k * F.col("_cxy") - F.col("_cx") * F.col("_cy")
    vx = k * F.col("_cxx") - F.col("_cx") * F.col("_cx")
    vy = k * F.col("_cyy") - F.col("_cy") * F.col("_cy")
    r = num.cast("double") / F.sqrt(vx.cast("double") * vy.cast("double"))
    return F.when(F.col("_cn") <= 2, F.lit(0.0)).when((vx > 0) & (vy > 0), r)


def correlation_band(r: Column) -> Column:
    """Strong positive / moderate / weak (negatives are weak)."""
    return (
        F.when(r > STRONG_CORRELATION, F.lit("strong positive"))
        .when(r > MODERATE_CORRELATION, F.lit("moderate"))
        .otherwise(F.lit("weak"))
    )


# --------------------------------------------------------------------------
# DataFrame-level operators
# --------------------------------------------------------------------------

def linear_trend_forecast(
    series: DataFrame,
    order_col: str,
    value_col: str,
    periods: int = 30,
    scale: int = 0,
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """OLS on the position index, then values at positions n..n+periods-1.

    Returns one row per forecast step (position, forecast) with the slope;
    no rows when fewer than two values exist (the reference's empty list).
    """
    pos = with_position(series, order_col, partition_cols)
    fit = pos.groupBy(*partition_cols).agg(*fit_parts("position", value_col, scale))
    fit = fit.select(
        *partition_cols,
        "_n",
        "_k",
        slope_expr(scale).alias("slope"),
        intercept_expr(scale).alias("intercept"),
    )
    steps = fit.where(F.col("_k") >= 2).select(
        *partition_cols,
        "slope",
        "intercept",
        F.explode(F.sequence(F.col("_n"), F.col("_n") + F.lit(periods - 1))).alias("position"),
    )
    return steps.select(
        *partition_cols,
        F.col("position").cast("long").alias("position"),
        (F.col("slope") * F.col("position") + F.col("intercept")).alias("forecast"),
        "slope",
    )


def trend_summary(
    series: DataFrame, order_col: str, value_col: str, scale: int = 0, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """T1 slope, T3 growth and T4 label of a series in one aggregation."""
    pos = with_position(series, order_col, partition_cols)
    agg = pos.groupBy(*partition_cols).agg(
        *fit_parts("position", value_col, scale), *growth_parts("position", value_col)
    )
    return agg.select(
        *partition_cols,
        slope_expr(scale).alias("slope"),
        growth_expr().alias("growth_rate"),
        trend_expr(scale).alias("trend"),
    )


def concentration_index(df: DataFrame, value_col: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """T5: max / sum of the values; 0 when empty or the sum is 0."""
    total = F.sum(F.col(value_col).cast("decimal(38,4)")).cast("double")
    agg = df.groupBy(*partition_cols).agg(F.max(value_col).cast("double").alias("_max"), total.alias("_sum"))
    return agg.select(
        *partition_cols,
        F.when(F.coalesce(F.col("_sum"), F.lit(0.0)) == 0, F.lit(0.0))
        .otherwise(F.col("_max") / F.col("_sum"))
        .alias("concentration_index"),
    )


def correlation(df: DataFrame, x: str, y: str, scale: int = 2) -> DataFrame:
    """T6 + T7 as a 1-row frame."""
    agg = df.agg(*corr_parts(x, y, scale))
    r = corr_expr()
    return agg.select(r.alias("correlation"), correlation_band(r).alias("correlation_band"))
