"""Sales lines folded to one row per product, invoice, customer or month.

Rows without the key are dropped, as a missing key belongs to no group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import exact_sum, year_month
from ledgerlark.operators.clean import remove_non_products, with_customer


def product_grain(lines: DataFrame, goods_only: bool = True) -> DataFrame:
    """Description, Revenue, Lines (all rows) and Frequency (rows with an invoice).

    Fee and accounting texts are left out unless ``goods_only`` is false.
    """
    return (
        (remove_non_products(lines) if goods_only else lines)
        .filter("Description IS NOT NULL")
        .groupBy("Description")
        .agg(
            exact_sum("Revenue").alias("Revenue"),
            F.count(F.lit(1)).alias("Lines"),
            F.count("InvoiceNo").alias("Frequency"),
        )
    )


def invoice_grain(lines: DataFrame) -> DataFrame:
    """InvoiceNo, OrderValue on a gross basis: cancelled originals stay in."""
    return (
        lines.filter("InvoiceNo IS NOT NULL")
        .groupBy("InvoiceNo")
        .agg(exact_sum("Revenue").alias("OrderValue"))
    )


def visit_grain(lines: DataFrame) -> DataFrame:
    """CustomerID, InvoiceNo, YearMonth, Revenue of known customers.

    Folding per invoice first spreads a customer with very many lines over many tasks.
    """
    return (
        with_customer(lines)
        .groupBy("CustomerID", "InvoiceNo", year_month("InvoiceDate").alias("YearMonth"))
        .agg(exact_sum("Revenue").alias("Revenue"))
    )


def customer_grain(visits: DataFrame) -> DataFrame:
    """CustomerID, TotalRevenue, OrderCount (different invoices)."""
    return visits.groupBy("CustomerID").agg(
        exact_sum("Revenue").alias("TotalRevenue"),
        F.count_distinct("InvoiceNo").alias("OrderCount"),
    )


def month_grain(lines: DataFrame) -> DataFrame:
    """YearMonth, Revenue, Lines and the last day loaded; only months that occur."""
    return (
        lines.filter("InvoiceDate IS NOT NULL")
        .groupBy(year_month("InvoiceDate").alias("YearMonth"))
        .agg(
            exact_sum("Revenue").alias("Revenue"),
            F.count(F.lit(1)).alias("Lines"),
            F.max(F.col("InvoiceDate").cast("date")).alias("LastDay"),
        )
    )
