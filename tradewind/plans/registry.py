"""Registration of queries with their comparison SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans.roles import ROLES, role_cte

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a function of (session, directory) with the SQL that gives the same rows."""
    def register(run: Run) -> Run:
        REGISTRY[name or run.__name__] = Query(run, with_ctes(sql) if sql else None)
        return run
    return register


# Named relations the comparison queries may use, each defined over earlier ones.
CTES: dict[str, str] = {f"r_{name}": role_cte(name) for name in ROLES}


def define(name: str, body: str) -> None:
    CTES[name] = f"{name} AS ({body})"


def with_ctes(body: str) -> str:
    """Prefix `body` with the relations it uses, directly or not."""
    body = body.strip()
    used: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                todo.append(CTES[name].split(" AS (", 1)[1])
    ctes = ", ".join(text for name, text in CTES.items() if name in used)
    recursive = "RECURSIVE " if "/*recursive*/" in ctes + body else ""
    if body.startswith("WITH "):
        body, ctes = body[len("WITH "):], ctes + (", " if ctes else "")
        return f"WITH {recursive}{ctes}{body}"
    return f"WITH {recursive}{ctes} {body}" if ctes else body


_UNITS = "pow(2.0::DOUBLE, 72)"


def _dtotal(value: str) -> str:
    """The sum in integers of 2^-72, read as a number from its digits, so that it is rounded once."""
    return f"(CAST(CAST(SUM(CAST(trunc(CAST({value} AS DOUBLE) * {_UNITS}) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {_UNITS})"


def dsum(value: str) -> str:
    return f"COALESCE({_dtotal(value)}, 0::DOUBLE)"


def dmean(value: str) -> str:
    return f"{_dtotal(value)} / NULLIF(COUNT({value}), 0)"


define("d_payments", f"""
    SELECT order_id, COUNT(payment_sequential) AS payment_sequential,
           STRING_AGG(payment_type, ', ' ORDER BY payment_sequential, payment_type) AS payment_type,
           CAST(SUM(payment_installments) AS BIGINT) AS payment_installments,
           {dsum('payment_value')} AS payment_value
    FROM r_payments GROUP BY order_id""")
define("d_reviews", f"""
    SELECT order_id, {dmean('review_score')} AS review_score,
           NULLIF(STRING_AGG(COALESCE(review_comment_title, 'nan'), ', '
                  ORDER BY review_sequence, COALESCE(review_comment_title, 'nan')), 'nan') AS review_comment_title,
           NULLIF(STRING_AGG(COALESCE(review_comment_message, 'nan'), ', '
                  ORDER BY review_sequence, COALESCE(review_comment_message, 'nan')), 'nan') AS review_comment_message
    FROM r_reviews GROUP BY order_id""")
define("d_geo", f"""
    SELECT geolocation_zip_code_prefix AS zip, {dmean('geolocation_lat')} AS lat, {dmean('geolocation_lng')} AS lng
    FROM r_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL GROUP BY 1""")
define("d_wide", """
    SELECT i.*, p.* EXCLUDE (product_id), t.product_category_name_english, o.* EXCLUDE (order_id),
           c.* EXCLUDE (customer_id), cg.lat AS customer_lat, cg.lng AS customer_lng,
           s.* EXCLUDE (seller_id), sg.lat AS seller_lat, sg.lng AS seller_lng,
           pay.* EXCLUDE (order_id), rev.* EXCLUDE (order_id)
    FROM r_order_items i
    LEFT JOIN r_products p ON i.product_id = p.product_id
    LEFT JOIN r_category_translation t ON p.product_category_name = t.product_category_name
    LEFT JOIN r_orders o ON i.order_id = o.order_id
    LEFT JOIN r_customers c ON o.customer_id = c.customer_id
    LEFT JOIN d_geo cg ON c.customer_zip_code_prefix = cg.zip
    LEFT JOIN r_sellers s ON i.seller_id = s.seller_id
    LEFT JOIN d_geo sg ON s.seller_zip_code_prefix = sg.zip
    LEFT JOIN d_payments pay ON i.order_id = pay.order_id
    LEFT JOIN d_reviews rev ON i.order_id = rev.order_id""")
define("d_facts", """
    SELECT *, price + freight_value AS item_total_revenue,
           CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month,
           CAST(year(order_purchase_timestamp) AS INTEGER) AS order_purchase_year,
           CAST(month(order_purchase_timestamp) AS INTEGER) AS order_purchase_month
    FROM d_wide""")
