"""Sales by period, product, category and place."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import exact_mean, exact_sum, month_start, percent
from tradewind.operators.ranking import best_per_group, top, with_share
from tradewind.sources.staging import stage

MOMENT = "order_purchase_timestamp"
PAID = "payment_value"
REVENUE = "item_total_revenue"
CATEGORY = "product_category_name_english"


def _present(*names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


def sales_by(
    df: DataFrame, keys: str | Sequence[str], money: str = REVENUE, total: str = "total_revenue",
    items: str | None = None, orders: str | None = None, grain: str = "item",
) -> DataFrame:
    """Revenue per group; rows with a NULL key are left out.

    `items` and `orders` name further columns for the number of items and of distinct
    orders. The payment value of an order stands on each of its items. Summed at
    `grain='item'` it counts once per item; `grain='order'` counts it once per order.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    df = df.where(_present(*keys))
    aggregates = [exact_sum(money, wide=money == PAID).alias(total)]
    if items:
        aggregates.append(F.count("order_item_id").alias(items))
    if grain == "order":
        df = df.groupBy(*keys, "order_id").agg(
            F.max(money).alias(money), F.count("order_item_id").alias("_items"))
        if items:
            aggregates[1] = F.sum("_items").alias(items)
    elif grain != "item":
        raise ValueError(f"grain is 'item' or 'order', not {grain!r}")
    if orders:
        aggregates.append(F.count_distinct("order_id").alias(orders))
    return df.groupBy(*keys).agg(*aggregates)


def with_month(df: DataFrame, moment: str = MOMENT, name: str = "month") -> DataFrame:
    return df.withColumn(name, month_start(moment))


def monthly_sales(df: DataFrame, money: str = PAID, grain: str = "item") -> DataFrame:
    return sales_by(with_month(df), "month", money, grain=grain)


def yearly_sales(df: DataFrame, money: str = PAID, grain: str = "item") -> DataFrame:
    return sales_by(df.withColumn("year", F.year(MOMENT)), "year", money, grain=grain)


def monthly_cancellations(df: DataFrame, status: str = "canceled") -> DataFrame:
    canceled = with_month(df.where(F.col("order_status") == status)).where(_present("month"))
    return canceled.groupBy("month").agg(F.count_distinct("order_id").alias("number_of_cancellations"))


def monthly_sales_with_cancellations(df: DataFrame, money: str = PAID, status: str = "canceled") -> DataFrame:
    """Revenue and distinct cancelled orders per month.

    Both come out of one aggregation: the cancelled order ids are the non-NULL values of
    a conditional column, so months without any get 0 and no join is needed.
    """
    canceled = F.when(F.col("order_status") == status, F.col("order_id"))
    return with_month(df).where(_present("month")).groupBy("month").agg(
        exact_sum(money, wide=money == PAID).alias("total_revenue"),
        F.count_distinct(canceled).alias("number_of_cancellations"))


def product_sales(df: DataFrame) -> DataFrame:
    return sales_by(df, "product_id", items="total_quantity_sold")


def category_sales(df: DataFrame) -> DataFrame:
    return sales_by(df, CATEGORY, items="total_quantity_sold")


def category_month_sales(df: DataFrame) -> DataFrame:
    """Revenue by category and month of the year; the years are pooled."""
    return sales_by(df, [CATEGORY, "order_purchase_month"], total="monthly_revenue")


def product_peak_month(df: DataFrame, k: int = 10) -> DataFrame:
    """The best month of the year of each of the k products with the highest revenue.

    One staged aggregation by product and month serves both the ranking and the peak.
    """
    monthly = stage(sales_by(df, ["product_id", "order_purchase_month"], total="monthly_revenue"), "product_months")
    leaders = top(sales_by(monthly, "product_id", "monthly_revenue"), "total_revenue", "product_id", k)
    detail = monthly.join(F.broadcast(leaders.select("product_id")), "product_id")  # k rows
    return best_per_group(detail, "product_id", "monthly_revenue", "order_purchase_month")


def top_category_months(df: DataFrame, k: int = 5) -> DataFrame:
    """Revenue by month of the year for the k categories with the highest revenue."""
    monthly = stage(category_month_sales(df), "category_months")
    leaders = top(sales_by(monthly, CATEGORY, "monthly_revenue"), "total_revenue", CATEGORY, k)
    return monthly.join(F.broadcast(leaders.select(CATEGORY)), CATEGORY, "left_semi")  # k rows


def category_share(df: DataFrame, k: int = 5) -> DataFrame:
    """The k best categories and their share of what these k earn together."""
    return with_share(top(sales_by(df, CATEGORY), "total_revenue", CATEGORY, k), "total_revenue")


def category_month_pivot(df: DataFrame) -> DataFrame:
    """A row per category, a column per month of the year, NULL without sales."""
    monthly = category_month_sales(df)
    months = monthly.groupBy(CATEGORY).pivot("order_purchase_month", list(range(1, 13)))
    pivoted = months.agg(F.max("monthly_revenue"))
    return pivoted.withColumnsRenamed({str(month): f"month_{month}" for month in range(1, 13)})


def category_growth(df: DataFrame) -> DataFrame:
    """Revenue of the last month minus that of the first, per category.

    First and last are those of the whole table; a category without sales in one of
    them counts as 0 there. The months are staged, a row per month and category, so the
    facts are read once for the edges and the sums.
    """
    monthly = stage(sales_by(with_month(df), ["month", CATEGORY]), "category_months")
    first, last = monthly.agg(F.min("month"), F.max("month")).first()

    def revenue_in(month: date | None) -> Column:
        return exact_sum(F.when(F.col("month") == F.lit(month).cast("date"), F.col("total_revenue")))

    edges = monthly.groupBy(CATEGORY).agg(revenue_in(last).alias("_last"), revenue_in(first).alias("_first"))
    return edges.select(CATEGORY, (F.col("_last") - F.col("_first")).alias("growth"))


def state_sales(df: DataFrame, money: str = PAID, grain: str = "item") -> DataFrame:
    return sales_by(df, "customer_state", money, orders="total_orders", grain=grain)


def city_sales(df: DataFrame, money: str = PAID, grain: str = "item") -> DataFrame:
    return sales_by(df, "customer_city", money, orders="total_orders", grain=grain)


def repeat_rate_by_state(df: DataFrame) -> DataFrame:
    """Customers per state, and those among them with more than one order anywhere.

    Orders and states are reduced to one row per customer and state, and the number of
    orders is taken per customer, so no list of customers is passed around.
    """
    customer, state = "customer_unique_id", "customer_state"
    seen = df.select(customer, state, "order_id").distinct()
    repeat = (
        seen.where(F.col(customer).isNotNull()).groupBy(customer)
        .agg(F.count_distinct("order_id").alias("_orders")).where("_orders > 1")
        .select(customer, F.lit(1).alias("_repeat"))
    )
    places = seen.where(_present(state)).select(state, customer).distinct()
    return (
        places.join(repeat, customer, "left").groupBy(state)
        .agg(F.count(customer).alias("unique_customers"), F.count("_repeat").alias("repeat_customers"))
        .withColumn("repeat_customer_rate", percent("repeat_customers", "unique_customers"))
    )


def top_category_per_state(df: DataFrame, categories: Sequence[str] | None = None, k: int = 3) -> DataFrame:
    """The best of the given categories per state; by default of the k best overall.

    The k best are found in the sums by state and category, so the facts are read once.
    """
    sums = df.where(_present(CATEGORY)).groupBy("customer_state", CATEGORY).agg(
        exact_sum(REVENUE).alias("category_revenue"))
    per_state = sums.where(_present("customer_state"))
    if categories is not None:
        per_state = per_state.where(F.col(CATEGORY).isin(list(categories)))
    else:
        sums = stage(sums, "state_categories")
        leaders = top(sales_by(sums, CATEGORY, "category_revenue"), "total_revenue", CATEGORY, k)
        per_state = sums.where(_present("customer_state")).join(
            F.broadcast(leaders.select(CATEGORY)), CATEGORY, "left_semi")  # k rows
    return best_per_group(per_state, "customer_state", "category_revenue", CATEGORY)


def promo_months(df: DataFrame) -> DataFrame:
    """Months of the year in which the mean price falls while the number of orders rises.

    The first month has nothing to compare with and is no promotion month. The window
    runs over at most twelve aggregated rows.
    """
    monthly = df.where(_present("order_purchase_month")).groupBy("order_purchase_month").agg(
        exact_mean("price").alias("average_price"), F.count_distinct("order_id").alias("monthly_orders"))
    order = Window.orderBy("order_purchase_month")
    falls = F.col("average_price") < F.lag("average_price").over(order)
    rises = F.col("monthly_orders") > F.lag("monthly_orders").over(order)
    return monthly.withColumn("is_promotion", F.coalesce(falls & rises, F.lit(False)))


def city_orders(df: DataFrame, category: str) -> DataFrame:
    """Items sold in one category, per city."""
    chosen = df.where((F.col(CATEGORY) == category) & _present("customer_city"))
    return chosen.groupBy("customer_city").agg(F.count("order_id").alias("order_count"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations in long form; each pair uses the rows where both are present."""
    pairs = [(a, b) for a in columns for b in columns]
    row = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs if a <= b])
    cells = F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                 F.col(f"{min(a, b)}__{max(a, b)}").alias("correlation"))
        for a, b in pairs
    ])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def price_sensitive(df: DataFrame, median_price: float, max_score: float = 3) -> DataFrame:
    """Items scored `max_score` or less that cost more than the median."""
    return df.where((F.col("review_score") <= max_score) & (F.col("price") > median_price))


def negative_feedback(df: DataFrame, max_score: float = 3) -> DataFrame:
    """Items scored `max_score` or less with a comment."""
    return df.where((F.col("review_score") <= max_score) & _present("review_comment_message"))
