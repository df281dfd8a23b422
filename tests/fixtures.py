"""Hand-made sales lines that hold every oddity the cleaning rules are about."""

from datetime import datetime

from ledgerlark.sources import SALES_LINES, as_sales_lines

NAN = float("nan")
D1, D2, D3 = datetime(2010, 12, 31, 23, 59, 59), datetime(2011, 2, 1), datetime(2011, 2, 28, 23, 59, 59)

EDGE_LINES = [
    # InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
    ("536365", "10002", "MUG", 2, D1, 2.5, 12346.0, "United Kingdom"),
    ("536365", "10002A", "PAPER CHAIN ", 1, D1, 10.0, 12346.0, "United Kingdom"),
    ("536366", "22139", "MUG", 1, D2, 2.5, None, "EIRE"),
    ("536367", "22139", "CUP", 4, D2, 0.001, 12347.0, "RSA"),
    ("C536379", "22139", "CUP", -4, D2, 0.5, 12347.0, "United Kingdom"),
    ("c1", "22139", "CUP", 3, D3, 1.0, 12347.0, "Ireland"),
    ("A563185", "B", "Adjust bad debt", 1, D3, 11062.06, None, "United Kingdom"),
    ("B1", "B", "MUG", 1, D3, 5.0, None, "United Kingdom"),
    (None, "10002", "MUG", 1, D3, 7.0, 12346.0, "United Kingdom"),
    ("536368", "10002", "MUG", 0, D3, 1.0, 12346.0, "United Kingdom"),
    ("536368", "10002", "MUG", None, D3, 1.0, 12346.0, "United Kingdom"),
    ("536368", "10002", "MUG", 1, D3, 0.0, 12346.0, "United Kingdom"),
    ("536368", "10002", "MUG", 1, D3, -1.0, 12346.0, "United Kingdom"),
    ("536368", "10002", "MUG", 1, D3, NAN, 12346.0, "United Kingdom"),
    ("536368", "10002", "MUG", 1, D3, None, 12346.0, "United Kingdom"),
    ("536369", "P", "POSTAGE", 1, D3, 20.0, 12346.0, "France"),
    ("536369", "P", "postage", 1, D3, 30.0, 12346.0, "France"),
    ("536370", "M", None, 2, D3, 4.0, 12348.0, None),
    ("536371", "M", "MUG", 80995, D3, 1.0, 12348.0, "Unspecified"),
    ("536371", "M", "MUG", 1, D3, 1.0, 12348.0, "European Community"),
]


def edge_lines(spark):
    return as_sales_lines(spark.createDataFrame(EDGE_LINES, SALES_LINES))


def lines_of(spark, values):
    """Lines from (InvoiceNo, Description, Revenue, CustomerID, date) tuples."""
    return as_sales_lines(
        spark.createDataFrame(
            [(i, "S", d, 1, t, float(r), c, "United Kingdom") for i, d, r, c, t in values], SALES_LINES
        )
    )
