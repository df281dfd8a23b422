"""Sales lines derived from the star-schema tables.

The tables hold clean orders.  Fixed arithmetic on their keys adds the returns,
accounting entries, fee lines, guests and odd country names that the cleaning rules
are about, so that the same rows can be derived again by any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.sources.readers import as_sales_lines

# Declared, so that opening a table reads no file footers on the driver.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders, customer, nation, part = (
        table(spark, sf_dir, name)
        for name in ("lineitem", "orders", "customer", "nation", "part")
    )
    # Customers and their nations are joined to the orders first, so the line table
    # is shuffled at most once per key.
    buyers = orders.join(
        customer.join(nation, customer.c_nationkey == nation.n_nationkey),
        orders.o_custkey == customer.c_custkey,
    )
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey).join(
        buyers, lineitem.l_orderkey == buyers.o_orderkey
    )
    return as_sales_lines(
        lines.selectExpr(
            """CASE WHEN l_orderkey % 37 = 5 THEN 'C' || l_orderkey
                    WHEN l_orderkey % 997 = 3 THEN 'A' || l_orderkey
                    ELSE string(l_orderkey) END AS InvoiceNo""",
            "string(l_partkey) AS StockCode",
            """CASE WHEN l_orderkey % 997 = 3 THEN 'Adjust bad debt'
                    WHEN l_partkey % 100 = 1 THEN 'POSTAGE'
                    WHEN l_partkey % 100 = 2 THEN 'DOTCOM POSTAGE'
                    WHEN l_partkey % 100 = 3 THEN 'Manual'
                    WHEN l_partkey % 100 = 4 AND l_orderkey % 3 = 0 THEN NULL
                    WHEN l_partkey % 50 = 7 AND l_orderkey % 2 = 0 THEN p_name || ' ' || p_brand || ' '
                    ELSE p_name || ' ' || p_brand END AS Description""",
            """int(IF(l_orderkey % 37 = 5 OR l_orderkey % 41 = 7 AND l_linenumber = 1,
                       -l_quantity, l_quantity)) AS Quantity""",
            "o_orderdate AS InvoiceDate",
            """IF((l_orderkey + l_partkey) % 211 = 0, 0D,
                  double(l_partkey % 900 + 100) / 100D) AS UnitPrice""",
            "IF(o_custkey % 4 = 0, NULL, o_custkey) AS CustomerID",
            """CASE WHEN n_nationkey >= 10 THEN 'United Kingdom'
                    WHEN n_nationkey = 1 THEN 'EIRE'
                    WHEN n_nationkey = 2 THEN 'RSA'
                    WHEN n_nationkey = 3 THEN 'Unspecified'
                    WHEN n_nationkey = 4 THEN 'European Community'
                    WHEN n_nationkey = 5 THEN 'Ireland'
                    WHEN n_nationkey = 6 AND l_linenumber = 1 THEN NULL
                    ELSE n_name END AS Country""",
        )
    )
