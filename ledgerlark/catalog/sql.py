"""Building blocks of the ANSI SQL that each registered query is checked against."""

from __future__ import annotations

# Sums of money run over decimals, as in the plans, so both sides add up exactly.
MONEY = "DECIMAL(24,6)"


def money(expression: str) -> str:
    return f"CAST(sum(CAST({expression} AS {MONEY})) AS DOUBLE)"


# Fixed values.
NOT_A_PRODUCT = (
    "'DOTCOM POSTAGE', 'POSTAGE', 'CARRIAGE', 'Manual', 'AMAZON FEE', 'Adjust bad debt'"
)

# name: (CTEs it reads, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "sales": (
        (),
        """
SELECT CASE WHEN l_orderkey % 37 = 5 THEN 'C' || CAST(l_orderkey AS VARCHAR)
            WHEN l_orderkey % 997 = 3 THEN 'A' || CAST(l_orderkey AS VARCHAR)
            ELSE CAST(l_orderkey AS VARCHAR) END AS InvoiceNo,
       CAST(l_partkey AS VARCHAR) AS StockCode,
       CASE WHEN l_orderkey % 997 = 3 THEN 'Adjust bad debt'
            WHEN l_partkey % 100 = 1 THEN 'POSTAGE'
            WHEN l_partkey % 100 = 2 THEN 'DOTCOM POSTAGE'
            WHEN l_partkey % 100 = 3 THEN 'Manual'
            WHEN l_partkey % 100 = 4 AND l_orderkey % 3 = 0 THEN NULL
            WHEN l_partkey % 50 = 7 AND l_orderkey % 2 = 0 THEN p_name || ' ' || p_brand || ' '
            ELSE p_name || ' ' || p_brand END AS Description,
       CAST(CASE WHEN l_orderkey % 37 = 5 OR l_orderkey % 41 = 7 AND l_linenumber = 1
                 THEN -l_quantity ELSE l_quantity END AS INT) AS Quantity,
       o_orderdate AS InvoiceDate,
       CAST(CASE WHEN (l_orderkey + l_partkey) % 211 = 0 THEN 0.0
                 ELSE (l_partkey % 900 + 100) / 100.0 END AS DOUBLE) AS UnitPrice,
       CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey END AS CustomerID,
       CASE WHEN n_nationkey >= 10 THEN 'United Kingdom' WHEN n_nationkey = 1 THEN 'EIRE'
            WHEN n_nationkey = 2 THEN 'RSA' WHEN n_nationkey = 3 THEN 'Unspecified'
            WHEN n_nationkey = 4 THEN 'European Community' WHEN n_nationkey = 5 THEN 'Ireland'
            WHEN n_nationkey = 6 AND l_linenumber = 1 THEN NULL ELSE n_name END AS Country
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    ),
    "named": (
        ("sales",),
        """
SELECT * REPLACE (CASE Country WHEN 'EIRE' THEN 'Ireland' WHEN 'RSA' THEN 'South Africa'
                  ELSE Country END AS Country)
FROM sales""",
    ),
    "clean": (
        ("named",),
        """
SELECT *, Quantity * UnitPrice AS Revenue FROM named
WHERE (Country IS NULL OR Country NOT IN ('Unspecified', 'European Community'))
  AND Quantity > 0 AND UnitPrice > 0
  AND (InvoiceNo IS NULL OR NOT regexp_matches(InvoiceNo, '^[A-BD-Za-bd-z]'))""",
    ),
    "goods": (
        ("clean",),
        f"""
SELECT * FROM clean WHERE Description IS NULL OR Description NOT IN ({NOT_A_PRODUCT})""",
    ),
    "products": (
        ("goods",),
        f"""
SELECT Description, {money('Revenue')} AS Revenue, count(*) AS Lines, count(InvoiceNo) AS Frequency
FROM goods WHERE Description IS NOT NULL GROUP BY Description""",
    ),
    "curve": (
        ("products",),
        f"""
SELECT Description, Revenue,
       CAST(sum(CAST(Revenue AS {MONEY})) OVER w AS DOUBLE) AS cumulative_revenue,
       CAST(sum(CAST(Revenue AS {MONEY})) OVER w AS DOUBLE)
         / (SELECT {money('Revenue')} FROM products) * 100 AS cumulative_pct,
       row_number() OVER w AS product_rank,
       row_number() OVER w / (SELECT count(*) FROM products) * 100 AS product_pct,
       (SELECT count(*) FROM products) AS n
FROM products
WINDOW w AS (ORDER BY Revenue DESC, Description ROWS UNBOUNDED PRECEDING)""",
    ),
    "invoices": (
        ("clean",),
        f"""
SELECT InvoiceNo, {money('Revenue')} AS OrderValue
FROM clean WHERE InvoiceNo IS NOT NULL GROUP BY InvoiceNo""",
    ),
    "customers": (
        ("clean",),
        f"""
SELECT CustomerID, {money('Revenue')} AS TotalRevenue, count(DISTINCT InvoiceNo) AS OrderCount
FROM clean WHERE CustomerID IS NOT NULL GROUP BY CustomerID""",
    ),
    "vips": (
        ("customers",),
        """
SELECT CustomerID FROM customers
WHERE TotalRevenue > (SELECT median(TotalRevenue) FROM customers)
  AND OrderCount > (SELECT median(OrderCount) FROM customers)""",
    ),
    "months": (
        ("clean",),
        f"""
SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, {money('Revenue')} AS Revenue,
       count(*) AS Lines, max(CAST(InvoiceDate AS DATE)) AS LastDay
FROM clean WHERE InvoiceDate IS NOT NULL GROUP BY 1""",
    ),
    "vip_months": (
        ("clean", "vips"),
        f"""
SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth,
       {money("CASE WHEN CustomerID IN (SELECT CustomerID FROM vips) THEN Revenue END")} AS vip,
       {money("CASE WHEN CustomerID NOT IN (SELECT CustomerID FROM vips) THEN Revenue END")} AS non_vip,
       {money("Revenue")} AS everyone
FROM clean WHERE CustomerID IS NOT NULL GROUP BY 1""",
    ),
    "valid": (
        ("named",),
        """
SELECT *, Quantity * UnitPrice AS Revenue FROM named
WHERE Description IS NOT NULL AND UnitPrice > 0 AND Quantity > 0""",
    ),
}


def query(body: str, *ctes: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the named CTEs, and those they read, in front of it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in _CTES[name][0]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in ctes:
        add(name)
    parts = [f"{name} AS ({_CTES[name][1]}\n)" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body.strip()
