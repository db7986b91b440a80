"""Column names and types of the nine raw tables.

The spelling `lenght` is the one the data uses.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _DOUBLE, _TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "order_items": _schema(
        order_id=_TEXT, order_item_id=_INT, product_id=_TEXT, seller_id=_TEXT,
        shipping_limit_date=_TIME, price=_DOUBLE, freight_value=_DOUBLE),
    "orders": _schema(
        order_id=_TEXT, customer_id=_TEXT, order_status=_TEXT, order_purchase_timestamp=_TIME,
        order_approved_at=_TIME, order_delivered_carrier_date=_TIME,
        order_delivered_customer_date=_TIME, order_estimated_delivery_date=_TIME),
    "customers": _schema(
        customer_id=_TEXT, customer_unique_id=_TEXT, customer_zip_code_prefix=_INT,
        customer_city=_TEXT, customer_state=_TEXT),
    "sellers": _schema(
        seller_id=_TEXT, seller_zip_code_prefix=_INT, seller_city=_TEXT, seller_state=_TEXT),
    "products": _schema(
        product_id=_TEXT, product_category_name=_TEXT, product_name_lenght=_DOUBLE,
        product_description_lenght=_DOUBLE, product_photos_qty=_DOUBLE, product_weight_g=_DOUBLE,
        product_length_cm=_DOUBLE, product_height_cm=_DOUBLE, product_width_cm=_DOUBLE),
    "category_translation": _schema(product_category_name=_TEXT, product_category_name_english=_TEXT),
    "payments": _schema(
        order_id=_TEXT, payment_sequential=_INT, payment_type=_TEXT, payment_installments=_INT,
        payment_value=_DOUBLE),
    "reviews": _schema(
        order_id=_TEXT, review_score=_INT, review_comment_title=_TEXT, review_comment_message=_TEXT),
    "geolocation": _schema(
        geolocation_zip_code_prefix=_INT, geolocation_lat=_DOUBLE, geolocation_lng=_DOUBLE),
}

# Free text may hold line ends. Only these tables are read with multiLine, because
# a multi-line CSV file cannot be split between tasks.
MULTI_LINE_TABLES = frozenset({"reviews"})

DAILY_SERIES_SCHEMA = T.StructType([
    T.StructField("order_date", T.DateType(), False),
    T.StructField("total_sales", _DOUBLE, False),
])
