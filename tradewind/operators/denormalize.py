"""From nine tables to one wide table at item grain.

Every child table is rolled up to one row per key before it meets the items, so an
item row is never multiplied. The attributes of an order (order, customer, payments,
reviews) are put together at order grain first. The items meet the products and the
sellers while they are narrow, and the many columns of their orders last, so these
are never shuffled at item grain. No side is broadcast by hint; the planner broadcasts
those whose measured size is below its threshold.

An order, product or seller may hold a large share of the items. Adaptive execution
splits its partition, but only in a join whose two inputs both come straight from a
shuffle, and only on the side whose rows a left join keeps. The joins here are built
to be of that kind.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import exact_mean, exact_parts, exact_total
from tradewind.operators.clean import (
    coerce_numbers, coerce_timestamps, drop_duplicate_rows, drop_missing, with_item_revenue,
)
from tradewind.operators.ordering import exact_quantiles
from tradewind.functions.text import normalized
from tradewind.sources.staging import stage

# Fixed value: the word a missing review text becomes when texts are joined.
MISSING_TEXT = "nan"
# Rows of one order that are joined into one partial text before the order is put together.
TEXT_CHUNK = 1000


def joined_text(
    df: DataFrame, key: str, texts: Mapping[str, Column], sequence: str,
    aggregates: Mapping[str, tuple[Column, Column]] | None = None, parts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per `key` with each text joined by ', ' in the order of `sequence`.

    `sequence` is an integer; equal numbers are ordered by the text. The rows of a key
    are joined in chunks of the sequence, so a key with very many rows is spread over
    tasks, and only finished partial texts meet in its final row. Where all rows are of
    the first chunk, one shuffle does; `df` is read once before to see that. It moves the rows
    as they are: they are narrower than lists and sums that hold a few of them, and all that
    the rows of an unsorted table would be combined to. `aggregates` adds plain aggregates as
    (partial, merge) pairs; the merge refers to the partial by name. `parts` says which rows
    have a text; it is NULL for a key without any of them.
    """
    aggregates, parts = aggregates or {}, parts or {}
    known = df.where(F.col(key).isNotNull())
    partial = [
        *[_in_order(sequence, text, parts.get(name)).alias(name) for name, text in texts.items()],
        *[first.alias(name) for name, (first, _) in aggregates.items()]]
    first_chunk = F.col(sequence).between(0, TEXT_CHUNK - 1)
    if known.where(~F.coalesce(first_chunk, F.lit(False))).isEmpty():
        chunks = known.repartition(F.col(key)).groupBy(key).agg(*partial)
        return chunks.groupBy(key).agg(
            *[F.first(name).alias(name) for name in texts], *[merge.alias(name) for name, (_, merge) in aggregates.items()])
    chunks = known.withColumn("_chunk", F.floor(F.col(sequence) / TEXT_CHUNK)).groupBy(key, "_chunk").agg(*partial)
    return chunks.groupBy(key).agg(
        *[_in_order("_chunk", F.col(name), F.col(name).isNotNull() if name in parts else None).alias(name) for name in texts],
        *[merge.alias(name) for name, (_, merge) in aggregates.items()])


def _in_order(sequence: str, text: Column, part: Column | None = None) -> Column:
    item = F.struct(F.col(sequence).alias("at"), text.alias("text"))
    ordered = F.sort_array(F.collect_list(item if part is None else F.when(part, item)))
    joined = F.array_join(F.transform(ordered, lambda item: item["text"]), ", ")
    return joined if part is None else F.when(F.max(part), joined)


def _payment_aggregates(sequence: Column | str = "payment_sequential") -> dict[str, tuple[Column, Column]]:
    return {
        "_count": (F.count(sequence), F.sum("_count")),
        "_installments": (F.sum(F.col("payment_installments").cast("bigint")),
                          F.coalesce(F.sum("_installments"), F.lit(0))),
        **{f"_part{i}": (F.sum(part), F.sum(f"_part{i}")) for i, part in enumerate(exact_parts("payment_value"))},
    }


def _payment_columns() -> dict[str, Column]:
    value = exact_total([name for name in _payment_aggregates() if name.startswith("_part")])
    return {
        "payment_sequential": F.col("_count"), "payment_type": F.col("payment_type"),
        "payment_installments": F.col("_installments"), "payment_value": F.coalesce(value, F.lit(0.0)),
    }


def payments_rollup(payments: DataFrame, order: str = "order_id") -> DataFrame:
    """One row per order: payments counted, types joined, instalments and value summed."""
    rolled = joined_text(
        payments, order, {"payment_type": F.col("payment_type")}, "payment_sequential", _payment_aggregates())
    return rolled.select(order, *[column.alias(name) for name, column in _payment_columns().items()])


def _review_texts() -> dict[str, Column]:
    return {name: F.coalesce(F.col(name), F.lit(MISSING_TEXT))
            for name in ("review_comment_title", "review_comment_message")}


def _review_aggregates() -> dict[str, tuple[Column, Column]]:
    return {
        "_scores": (F.sum(F.col("review_score").cast("double")), F.sum("_scores")),
        "_rated": (F.count("review_score"), F.sum("_rated")),
    }


def _review_columns() -> dict[str, Column]:
    return {
        "review_score": F.try_divide("_scores", "_rated"),
        **{name: F.when(F.col(name) != MISSING_TEXT, F.col(name)) for name in _review_texts()},
    }


def reviews_rollup(reviews: DataFrame, order: str = "order_id", sequence: str | None = None) -> DataFrame:
    """One row per order: mean score, titles and messages joined.

    A missing text takes part in the join as the word `nan`. A joined text that is just
    this word, i.e. that of one review without text, is missing. Without a `sequence`
    column the texts of an order are joined in alphabetical order, and in one piece.
    """
    if sequence is None:
        reviews, sequence = reviews.withColumn("_sequence", F.lit(0)), "_sequence"
    rolled = joined_text(reviews, order, _review_texts(), sequence, _review_aggregates())
    return rolled.select(order, *[column.alias(name) for name, column in _review_columns().items()])


def payments_and_reviews_rollup(payments: DataFrame, reviews: DataFrame, sequence: str | None = None) -> DataFrame:
    """`payments_rollup` and `reviews_rollup` side by side, as by a full join, from one shuffle of the rows of both."""
    rows = payments.select(
        "order_id", F.lit(True).alias("_paid"), F.col("payment_sequential").cast("bigint").alias("_at"),
        "payment_type", "payment_installments", "payment_value",
    ).unionByName(reviews.select(
        "order_id", F.lit(False).alias("_paid"),
        (F.col(sequence) if sequence else F.lit(0)).cast("bigint").alias("_at"),
        "review_score", "review_comment_title", "review_comment_message"), allowMissingColumns=True)
    paid, reviewed = F.col("_paid"), ~F.col("_paid")
    rolled = joined_text(
        rows, "order_id", {"payment_type": F.col("payment_type"), **_review_texts()}, "_at",
        {**_payment_aggregates(F.when(paid, F.col("_at"))), **_review_aggregates(),
         "_any_paid": (F.max(paid), F.max("_any_paid")), "_any_reviewed": (F.max(reviewed), F.max("_any_reviewed"))},
        {"payment_type": paid, **{name: reviewed for name in _review_texts()}})
    return rolled.select(
        "order_id", *[F.when(F.col("_any_paid"), column).alias(name) for name, column in _payment_columns().items()],
        *[F.when(F.col("_any_reviewed"), column).alias(name) for name, column in _review_columns().items()])


def with_category_name(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(translation, "product_category_name", "left")


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Mean position per zip prefix: zip_code, lat, lng."""
    prefix = F.col("geolocation_zip_code_prefix")
    return geolocation.where(prefix.isNotNull()).groupBy(prefix.alias("zip_code")).agg(
        exact_mean("geolocation_lat").alias("lat"), exact_mean("geolocation_lng").alias("lng"))


def only_known_zips(geolocation: DataFrame, people: DataFrame, zip_code: str) -> DataFrame:
    """The geolocation rows whose prefix occurs among `people`."""
    known = people.select(F.col(zip_code).alias("geolocation_zip_code_prefix")).distinct()
    return geolocation.join(stage(known, "zips"), "geolocation_zip_code_prefix", "left_semi")


def with_position(people: DataFrame, centroids: DataFrame, role: str) -> DataFrame:
    """Add `<role>_lat` and `<role>_lng` by `<role>_zip_code_prefix`.

    `centroids` has a row per prefix, and the left join ignores prefixes nobody lives in,
    so no semi-join is needed to reduce them first.
    """
    names = {"zip_code": f"{role}_zip_code_prefix", "lat": f"{role}_lat", "lng": f"{role}_lng"}
    return people.join(centroids.withColumnsRenamed(names), names["zip_code"], "left")


PARTS = ("product", "order", "customer", "seller", "payment", "review")


def _is_broadcast(side: DataFrame) -> bool:
    """Whether the planner will broadcast `side`, by the size it knows. `side` should be staged."""
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def denormalize(tables: Mapping[str, DataFrame], parts: Sequence[str] = PARTS, review_sequence: str | None = None,
                whole: bool = False, without: Sequence[str] = ()) -> DataFrame:
    """Items with the attributes of the chosen `parts`; with all of them 41 columns.

    Positions are added to customers and sellers where `tables` has a geolocation. The columns
    `without` are left out. `whole` says that all others will be read. What the items meet is then
    staged: the files of the shuffles that made it are gone before the items are shuffled, and a side
    that turns out small enough to be broadcast meets them last, so they are not shuffled for it, nor with its columns.
    """
    centroids = stage(zip_centroids(tables["geolocation"]), "centroids") if "geolocation" in tables else None

    def located(role: str, people: DataFrame) -> DataFrame:
        return people if centroids is None else with_position(people, centroids, role)

    # A full outer join keeps the payments and reviews of an order that is missing in
    # `orders`: its items get them all the same.
    per_order = []
    if "order" in parts:
        orders = tables["orders"]
        if "customer" in parts:
            orders = orders.join(located("customer", tables["customers"]), "customer_id", "left")
        per_order.append(orders)
    if "payment" in parts and "review" in parts:
        per_order.append(payments_and_reviews_rollup(tables["payments"], tables["reviews"], review_sequence))
    elif "payment" in parts:
        per_order.append(payments_rollup(tables["payments"]))
    elif "review" in parts:
        per_order.append(reviews_rollup(tables["reviews"], sequence=review_sequence))

    sides = []
    if per_order:
        attributes = per_order[0]
        for other in per_order[1:]:
            attributes = attributes.join(other, "order_id", "full")
        attributes = attributes.drop(*without)
        if whole:
            attributes = stage(attributes, "attributes")
        elif len(per_order) == 1 and "order" not in parts:
            # A roll-up is partitioned by its key and would be joined in the stage that
            # aggregates it, where the items of a hot order cannot be split off.
            attributes = stage(attributes, "rollup")
        sides.append(("order_id", attributes))
    if "product" in parts:
        sides.append(("product_id", with_category_name(tables["products"], tables["category_translation"])))
    if "seller" in parts:
        sides.append(("seller_id", located("seller", tables["sellers"])))
    if whole:
        sides = [(key, side if key == "order_id" else stage(side, key)) for key, side in sides]
    wide, columns = tables["order_items"], tables["order_items"].columns
    for key, side in sides:
        columns = [key, *[name for name in [*columns, *side.columns] if name != key]]
    # The order's many columns come last: they would be shuffled with every item of it. No item is shuffled for a small side.
    for key, side in sorted(sides, key=lambda side: 2 if whole and _is_broadcast(side[1]) else side[0] == "order_id"):
        wide = wide.join(side, key, "left")
    return wide.select(*[name for name in columns if name not in without])


# Text and number columns of the rebuilt table, as opposed to its dates and ids.
REBUILT_TEXT = (
    "product_category_name_english", "customer_city", "customer_state", "seller_city", "seller_state",
    "payment_type", "order_status", "product_category_name",
)
REBUILT_NUMBERS = (
    "price", "freight_value", "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    "payment_sequential", "payment_installments", "payment_value", "review_score",
)


def _left_join_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """`one.join(many, key, 'left')`, where a key may hold a large share of `many`.

    A left join could not split such a key. The inner join of the keys both have can, and
    the keys without any rows are added.
    """
    matched = one.join(many, key)
    alone = one.join(many.select(key).distinct(), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def _children(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What meets in an order: the order with its customer, items with product and seller, payments, reviews."""
    products = with_category_name(tables["products"], tables["category_translation"])
    return {
        "orders": tables["orders"].join(tables["customers"], "customer_id", "left"),
        "items": tables["order_items"].join(products, "product_id", "left").join(tables["sellers"], "seller_id", "left"),
        "payments": tables["payments"], "reviews": tables["reviews"],
    }


def join_from_orders(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orders with customers, items, products, sellers and the raw payments and reviews.

    Payments and reviews are not rolled up here: an order has a row for every
    combination of its items, payments and reviews.
    """
    products = with_category_name(tables["products"], tables["category_translation"])
    orders = tables["orders"].join(tables["customers"], "customer_id", "left")
    return (
        _left_join_many(orders, tables["order_items"], "order_id")
        .join(products, "product_id", "left")
        .join(tables["sellers"], "seller_id", "left")
        .join(tables["payments"], "order_id", "left")
        .join(tables["reviews"], "order_id", "left")
    )


# Rows of one order that are built in one task; an order with more combinations is cut into slices of its items.
SLICE_ROWS = 5_000_000
_MANY = ("items", "payments", "reviews")


def _multiplicities(children: Mapping[str, DataFrame]) -> DataFrame:
    """The staged number of rows that every order has in each child; 1 where it has none."""
    counts = [children[name].groupBy("order_id").agg(F.count("*").alias(f"_{name}")) for name in ("orders", *_MANY)]
    joined = counts[0].where("order_id IS NOT NULL")
    for other in counts[1:]:
        joined = joined.join(other, "order_id", "left")
    sizes = {f"_{name}": F.coalesce(f"_{name}", F.lit(1).cast("bigint")) for name in _MANY}
    return stage(joined.withColumns(sizes), "multiplicities")


def _joined_medians(children: Mapping[str, DataFrame], sizes: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The median of each column over the rows of the joined table, from its child alone.

    A row of a child stands in as many joined rows as the other children of its order have
    combinations, and counts as often.
    """
    medians: dict[str, float | None] = {}
    for name in _MANY:
        own = [column for column in columns if column in children[name].columns]
        weight = F.col("_orders")
        for other in _MANY:
            weight = weight * F.col(f"_{other}") if other != name else weight
        weighed = stage(children[name].select("order_id", *own).join(sizes, "order_id").select(
            *own, weight.alias("_weight")), "weighed")
        medians |= {column: median for column, (median,) in exact_quantiles(
            weighed, {column: [0.5] for column in own}, weight="_weight").items()}
    return medians


def _combined(children: Mapping[str, DataFrame], sizes: DataFrame) -> DataFrame:
    """Every combination of an order with its items, payments and reviews, each missing child as NULLs.

    All joins are by order, so nothing is shuffled once rows begin to multiply. The items of
    an order with very many combinations are dealt to slices, and the rest of the order goes to each.
    """
    combinations = F.col("_orders") * F.col("_items") * F.col("_payments") * F.col("_reviews")
    slices = F.least(F.ceil(combinations / SLICE_ROWS), F.col("_items")).cast("bigint")
    heavy = stage(sizes.select("order_id", slices.alias("_slices")).where("_slices > 1"), "heavy")
    keys = ["order_id"]
    if not heavy.isEmpty():
        keys = ["order_id", "_slice"]
        count = F.coalesce("_slices", F.lit(1).cast("bigint"))
        place = F.pmod(F.xxhash64(*[F.col(name) for name in children["items"].columns]), count)
        dealt = {}
        for name, child in children.items():
            known = child.join(heavy, "order_id", "left")
            dealt[name] = known.withColumn(
                "_slice", place if name == "items" else F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))
        orders = dealt["orders"].withColumn("_cut", F.col("_slices").isNotNull()).drop("_slices")
        items = dealt["items"].withColumn("_item", F.lit(True)).drop("_slices")
        # A slice that got no item of its order is not an order without items.
        joined = orders.join(items, keys, "left").where("_item OR NOT _cut").drop("_item", "_cut")
        children = {name: dealt[name].drop("_slices") for name in ("payments", "reviews")}
    else:
        joined = children["orders"].join(children["items"], keys, "left")
    return joined.join(children["payments"], keys, "left").join(children["reviews"], keys, "left").drop("_slice")


def rebuild_wide(tables: Mapping[str, DataFrame], fill: str = "median") -> DataFrame:
    """The table to work with when no cleaned one exists.

    `fill='median'` fills every number with its median over the joined rows and normalises the texts;
    `fill='zero'` only turns missing prices and freights into 0. Both add
    `item_total_revenue` and drop rows without a purchase time, and duplicates.

    An order has a row for every combination of its items, payments and reviews. Two of these
    are equal if their parts are, so each child is filled and freed of duplicates before
    the join, and the medians are taken of the children, weighted: the combinations are
    built once, for the result.
    """
    if fill not in ("median", "zero"):
        raise ValueError(f"fill is 'median' or 'zero', not {fill!r}")
    columns = join_from_orders(tables).columns
    children = {}
    for name, child in _children(tables).items():
        if fill == "median":
            moments = [column for column in child.columns if "date" in column or "timestamp" in column]
            child = coerce_timestamps(child, moments)
            child = coerce_numbers(child, [column for column in REBUILT_NUMBERS if column in child.columns])
        else:
            child = coerce_timestamps(child, [c for c in ("order_purchase_timestamp",) if c in child.columns])
            child = coerce_numbers(child, [c for c in ("price", "freight_value") if c in child.columns])
        if fill == "median" and name == "items":
            child = child.withColumn(
                "product_category_name_english", F.coalesce("product_category_name_english", "product_category_name"))
        children[name] = stage(child, name)
    sizes = _multiplicities(children)
    numbers = _joined_medians(children, sizes, REBUILT_NUMBERS) if fill == "median" else {"price": 0.0, "freight_value": 0.0}
    words = {
        "review_comment_message": "no_comment", "review_comment_title": "no_comment",
        "payment_type": "unknown", "order_status": "unknown", "product_category_name": "unknown",
    } if fill == "median" else {}

    def filled(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {name: F.coalesce(F.col(name).cast("double"), F.lit(value).cast("double"))
             for name, value in numbers.items() if name in df.columns}
            | {name: F.coalesce(F.col(name), F.lit(word)) for name, word in words.items() if name in df.columns})

    def tidied(df: DataFrame) -> DataFrame:
        """Texts normalised in the child: in the result each of its rows stands many times."""
        names = [name for name in REBUILT_TEXT if name in df.columns] if fill == "median" else []
        return df.withColumns({name: normalized(name, missing_word=MISSING_TEXT) for name in names})

    # The rows that a left join adds for orders without items, payments or reviews are filled after it.
    table = filled(_combined({name: tidied(drop_duplicate_rows(filled(child))) for name, child in children.items()}, sizes))
    table = with_item_revenue(table.select(*columns))
    if fill == "zero":
        return drop_missing(table, ["order_purchase_timestamp", "item_total_revenue"])
    table = drop_missing(table, ["order_id", "customer_id", "order_purchase_timestamp", "item_total_revenue"])
    return table.na.fill(MISSING_TEXT, subset=list(REBUILT_TEXT))
