"""The numeric metrics behind each dashboard insight block.

Each block is one global aggregation over a published table (or its exact
measures), returning a 1-row DataFrame; the prose around the numbers is not
built. "First row" / "last row" mean the published ordering (metric
descending on the exact value, key ascending, nulls last), expressed as
``min_by`` / ``max_by`` over an explicit ordering struct, so no sort and no
driver round trip is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.money import round_div, to_cents
from orderlens.operators import marts
from orderlens.operators import trends as T


def _desc_key(metric: Column, key: Column) -> Column:
    """Ordering struct of 'metric desc nulls last, key asc' for min_by."""
    return F.struct(metric.isNull(), -metric, key)


def first_by(value: Column, metric: Column, key: Column) -> Column:
    return F.min_by(value, _desc_key(metric, key))


def last_by(value: Column, metric: Column, key: Column) -> Column:
    return F.max_by(value, _desc_key(metric, key))


def _dsum(c: Column, scale: int = 4) -> Column:
    """Exact sum of published values, as a double."""
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double")


def _share(part: Column, total: Column) -> Column:
    return F.when(total > 0, part.cast("double") / total.cast("double")).otherwise(F.lit(0.0))


def _mean(c: Column, scale: int = 4) -> Column:
    return F.coalesce(_dsum(c, scale) / F.count(c), F.lit(0.0))


def _lift(top: Column, mean: Column) -> Column:
    return F.when(mean != 0, (top - mean) / mean)


# --------------------------------------------------------------------------

def kpi_summary(facts: DataFrame) -> DataFrame:
    """The KPI row itself."""
    return marts.kpi_summary(facts)


def orders_per_day(facts: DataFrame) -> DataFrame:
    """Trend label, growth, mean and peak of daily distinct orders."""
    series = T.with_position(marts.date_measures(facts), "purchase_date")
    agg = series.agg(
        *T.fit_parts("position", "order_count", 0),
        *T.growth_parts("position", "order_count"),
        F.sum("order_count").alias("_total"),
        F.max("order_count").alias("_peak"),
    )
    return agg.select(
        T.trend_expr(0).alias("trend"),
        T.growth_expr().alias("growth_rate"),
        F.coalesce(F.try_divide(F.col("_total").cast("double"), F.col("_k")), F.lit(0.0)).alias("avg_daily_orders"),
        F.coalesce(F.col("_peak"), F.lit(0)).cast("long").alias("peak_daily_orders"),
    )


def order_status(facts: DataFrame) -> DataFrame:
    """Delivered and canceled shares of distinct orders."""
    t = marts.order_status_breakdown(facts)
    total = F.sum("order_count")
    part = lambda s: F.coalesce(F.sum(F.when(F.col("order_status") == s, F.col("order_count"))), F.lit(0))
    return t.agg(
        F.coalesce(total, F.lit(0)).cast("long").alias("total_orders"),
        _share(part("delivered"), total).alias("delivered_share"),
        _share(part("canceled"), total).alias("canceled_share"),
    )


def _top_share_block(m: DataFrame, key: str, exact: str, value: Column, label: str, with_conc: bool) -> DataFrame:
    v = value
    cols = [
        first_by(F.col(key), F.col(exact), F.col(key)).alias(f"top_{label}"),
        first_by(v, F.col(exact), F.col(key)).alias("top_value"),
        _dsum(v).alias("_total"),
        F.max(v).cast("double").alias("_max"),
    ]
    agg = m.agg(*cols)
    out = [
        F.col(f"top_{label}"),
        F.col("top_value"),
        _share(F.col("top_value"), F.col("_total")).alias("top_share"),
    ]
    if with_conc:
        out.append(
            F.when(F.coalesce(F.col("_total"), F.lit(0.0)) == 0, F.lit(0.0))
            .otherwise(F.col("_max") / F.col("_total"))
            .alias("concentration_index")
        )
    return agg.select(*out)


def revenue_by_state(facts: DataFrame) -> DataFrame:
    """I4: leading state, its revenue share, concentration (max / sum)."""
    m = marts.state_measures(facts)
    return _top_share_block(m, "customer_state", "revenue_exact", to_cents(F.col("revenue_exact")), "state", True)


def orders_by_state(facts: DataFrame) -> DataFrame:
    """Leading state by distinct orders and its share."""
    m = marts.state_measures(facts)
    return _top_share_block(m, "customer_state", "unique_orders", F.col("unique_orders"), "state", False)


def avg_order_value_by_state(facts: DataFrame) -> DataFrame:
    """Leading state, mean of the state values, lift of the leader."""
    m = marts.aov_measures(facts)
    exact, pub, key = marts.avg_exact("aov"), marts.avg_out("aov"), F.col("customer_state")
    agg = m.agg(
        first_by(key, exact, key).alias("top_state"),
        first_by(pub, exact, key).alias("top_value"),
        _mean(pub).alias("mean_value"),
    )
    return agg.select("top_state", "top_value", "mean_value", _lift(F.col("top_value"), F.col("mean_value")).alias("lift"))


def top_cities(facts: DataFrame) -> DataFrame:
    """Leading city and its share of the top-10 total."""
    top = marts.revenue_by(facts, "customer_city").orderBy(
        F.col("revenue_exact").desc_nulls_last(), F.col("customer_city").asc_nulls_last()
    ).limit(marts.TOP_N)
    return _top_share_block(top, "customer_city", "revenue_exact", to_cents(F.col("revenue_exact")), "city", False)


def revenue_by_category(facts: DataFrame) -> DataFrame:
    """I8: leading category, its share, concentration."""
    m = marts.category_measures(facts)
    return _top_share_block(
        m, "product_category_name", "revenue_exact", to_cents(F.col("revenue_exact")), "category", True
    )


def _best_worst(m: DataFrame, key: str, exact: Column, published: Column, label: str) -> DataFrame:
    agg = m.agg(
        first_by(F.col(key), exact, F.col(key)).alias(f"best_{label}"),
        first_by(published, exact, F.col(key)).alias("best_score"),
        last_by(F.col(key), exact, F.col(key)).alias(f"worst_{label}"),
        last_by(published, exact, F.col(key)).alias("worst_score"),
        _mean(published).alias("mean_score"),
    )
    return agg


def review_score_by_category(facts: DataFrame) -> DataFrame:
    """Best and worst category by average score, unweighted mean."""
    m = marts.category_measures(facts)
    return _best_worst(m, "product_category_name", marts.avg_exact("score"), marts.avg_out("score"), "category")


def freight_vs_price(facts: DataFrame) -> DataFrame:
    """Correlation of average price and freight across categories, leaders."""
    m = marts.category_measures(facts).select(
        "product_category_name",
        marts.avg_exact("price").alias("price_exact"),
        marts.avg_out("price").alias("avg_price"),
        marts.avg_out("freight").alias("avg_freight"),
    )
    key = F.col("product_category_name")
    agg = m.agg(
        *T.corr_parts("avg_price", "avg_freight", 2),
        first_by(key, F.col("price_exact"), key).alias("high_price_category"),
        F.max("avg_price").alias("high_price"),
        F.min_by(key, F.struct(F.col("avg_freight").isNull(), -F.col("avg_freight"),
                               F.col("price_exact").isNull(), -F.col("price_exact"), key)).alias("high_freight_category"),
        F.max("avg_freight").alias("high_freight"),
    )
    r = T.corr_expr()
    return agg.select(
        r.alias("correlation"),
        T.correlation_band(r).alias("correlation_band"),
        "high_price_category",
        "high_price",
        "high_freight_category",
        "high_freight",
    )


def payment_orders(facts: DataFrame) -> DataFrame:
    """Credit card and boleto order counts, card share, residual share."""
    t = marts.orders_by_payment_type(facts)
    cnt = lambda s: F.coalesce(F.sum(F.when(F.col("payment_type") == s, F.col("order_count"))), F.lit(0))
    agg = t.agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("total"),
        cnt("credit_card").alias("credit_card_orders"),
        cnt("boleto").alias("boleto_orders"),
    )
    return agg.select(
        F.col("total").cast("long").alias("total_orders"),
        F.col("credit_card_orders").cast("long").alias("credit_card_orders"),
        F.col("boleto_orders").cast("long").alias("boleto_orders"),
        _share(F.col("credit_card_orders"), F.col("total")).alias("credit_card_share"),
        _share(F.col("total") - F.col("credit_card_orders") - F.col("boleto_orders"), F.col("total")).alias(
            "other_share"
        ),
    )


def installments(facts: DataFrame) -> DataFrame:
    """Modal instalment count (null if rows without one are the most; 1 for no rows), its share, share of rows with >1 instalment."""
    t = marts.installments_distribution(facts)
    inst, cnt = F.col("payment_installments"), F.col("count")
    order = F.struct(-cnt, inst.isNull(), inst)
    agg = t.agg(
        # a struct, since min_by alone would pass over a null count of instalments
        F.min(F.struct(order.alias("_o"), inst.alias("_i")))["_i"].alias("_mode"),
        F.max(cnt).alias("_mode_count"),
        F.sum(cnt).alias("_total"),
        F.coalesce(F.sum(F.when(inst > 1, cnt)), F.lit(0)).alias("_multi"),
    )
    return agg.select(
        F.when(F.col("_total").isNull(), F.lit(1)).otherwise(F.col("_mode").cast("long")).alias("mode_installments"),
        F.coalesce(F.col("_mode_count"), F.lit(0)).cast("long").alias("mode_count"),
        _share(F.col("_mode_count"), F.col("_total")).alias("mode_share"),
        _share(F.col("_multi"), F.col("_total")).alias("multi_installment_share"),
    )


def avg_payment_by_type(facts: DataFrame) -> DataFrame:
    """Leading type by average payment, mean over types, lift."""
    m = marts.payment_measures(facts)
    exact, pub, key = marts.avg_exact("payment"), marts.avg_out("payment"), F.col("payment_type")
    agg = m.agg(
        first_by(key, exact, key).alias("top_type"),
        first_by(pub, exact, key).alias("top_value"),
        _mean(pub).alias("mean_value"),
    )
    return agg.select("top_type", "top_value", "mean_value", _lift(F.col("top_value"), F.col("mean_value")).alias("lift"))


def on_time_vs_late(facts: DataFrame) -> DataFrame:
    """On-time and late shares of rows."""
    t = marts.on_time_vs_late_delivery(facts)
    total = F.sum("count")
    part = lambda s: F.coalesce(F.sum(F.when(F.col("delivery_status") == s, F.col("count"))), F.lit(0))
    return t.agg(_share(part("on_time"), total).alias("on_time_share"), _share(part("late"), total).alias("late_share"))


def late_delivery_by_state(facts: DataFrame) -> DataFrame:
    """Worst state by late rate, mean of the state rates, lift."""
    m = marts.state_measures(facts)
    exact = F.col("late_rows").cast("double") / F.col("total_rows").cast("double")
    pub = round_div(F.col("late_rows"), F.col("total_rows"), 4)
    key = F.col("customer_state")
    agg = m.agg(
        first_by(key, exact, key).alias("worst_state"),
        first_by(pub, exact, key).alias("worst_rate"),
        _mean(pub).alias("mean_rate"),
    )
    return agg.select(
        "worst_state", "worst_rate", "mean_rate", _lift(F.col("worst_rate"), F.col("mean_rate")).alias("lift")
    )


def delay_trend(facts: DataFrame) -> DataFrame:
    """I16: trend of the daily average delay and what it means, first and last value, change."""
    series = T.with_position(marts.delay_trend_over_time(facts), "purchase_date")
    agg = series.agg(*T.fit_parts("position", "avg_delay_days", 2), *T.growth_parts("position", "avg_delay_days"))
    return agg.select(
        T.trend_expr(2).alias("trend"),
        F.when(T.trend_expr(2) == "decreasing", "improving")
        .when(T.trend_expr(2) == "increasing", "worsening")
        .otherwise("stable")
        .alias("label"),
        F.coalesce(F.col("_first"), F.lit(0.0)).alias("earliest"),
        F.coalesce(F.col("_last"), F.lit(0.0)).alias("latest"),
        (F.coalesce(F.col("_first"), F.lit(0.0)) - F.coalesce(F.col("_last"), F.lit(0.0))).alias("improvement"),
    )


def review_distribution(facts: DataFrame) -> DataFrame:
    """5-star and 1-star shares; the null-score group stays in the total."""
    t = marts.review_score_distribution(facts)
    total = F.sum("count")
    part = lambda s: F.coalesce(F.sum(F.when(F.col("review_score") == s, F.col("count"))), F.lit(0))
    return t.agg(
        F.coalesce(total, F.lit(0)).cast("long").alias("total_rows"),
        _share(part(5.0), total).alias("five_star_share"),
        _share(part(1.0), total).alias("one_star_share"),
    )


def review_score_by_state(facts: DataFrame) -> DataFrame:
    """Best and worst state by average score, gap, unweighted mean."""
    m = marts.state_measures(facts)
    agg = _best_worst(m, "customer_state", marts.avg_exact("score"), marts.avg_out("score"), "state")
    return agg.select(
        "best_state",
        "best_score",
        "worst_state",
        "worst_score",
        (F.col("best_score") - F.col("worst_score")).alias("score_gap"),
        "mean_score",
    )


def delay_vs_review(facts: DataFrame) -> DataFrame:
    """Correlation of score and average delay; score with the largest delay."""
    t = marts.delay_vs_review_score(facts)
    s, d = F.col("review_score"), F.col("avg_delay_days")
    agg = t.agg(
        *T.corr_parts("review_score", "avg_delay_days", 2),
        F.min_by(s, F.struct(d.isNull(), -d, s.isNull(), s)).alias("_worst"),
    )
    return agg.select(T.corr_expr().alias("correlation"), F.coalesce(F.col("_worst"), F.lit(1.0)).alias("worst_score"))


BLOCKS = {
    "kpi_summary": kpi_summary,
    "orders_per_day": orders_per_day,
    "order_status": order_status,
    "revenue_by_state": revenue_by_state,
    "orders_by_state": orders_by_state,
    "avg_order_value_by_state": avg_order_value_by_state,
    "top_cities": top_cities,
    "revenue_by_category": revenue_by_category,
    "review_score_by_category": review_score_by_category,
    "freight_vs_price": freight_vs_price,
    "payment_orders": payment_orders,
    "installments": installments,
    "avg_payment_by_type": avg_payment_by_type,
    "on_time_vs_late": on_time_vs_late,
    "late_delivery_by_state": late_delivery_by_state,
    "delay_trend": delay_trend,
    "review_distribution": review_distribution,
    "review_score_by_state": review_score_by_state,
    "delay_vs_review": delay_vs_review,
}
