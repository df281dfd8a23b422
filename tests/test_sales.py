from datetime import datetime

import pytest
from fixtures import edge_lines, lines_of

from ledgerlark.operators import clean as rules
from ledgerlark.operators.grain import customer_grain, visit_grain
from ledgerlark.plans import charts, customers as q5, markets, months, orders as q4, products as q3
from ledgerlark.sources import sales_lines

JAN, FEB = datetime(2011, 1, 5), datetime(2011, 2, 5)


@pytest.fixture(scope="module")
def cleaned(spark):
    return rules.clean(edge_lines(spark)).cache()


def test_uk_split_counts_unknown_countries_as_other(cleaned, rows):
    got = dict(rows(markets.uk_vs_others(cleaned)))
    assert got == {"United Kingdom": 22.0, "Other Countries": 2.5 + 0.004 + 3.0 + 50.0 + 8.0}


def test_country_share_is_of_all_revenue(cleaned):
    got = [tuple(r) for r in markets.country_revenue(cleaned).collect()]
    total = 22.0 + 63.504
    assert [r[0] for r in got] == ["France", "Ireland", "South Africa"]
    assert got[0][1:] == (50.0, round(50 / total * 100, 2))
    assert got[2][1] == 0.004


def test_months_are_calendar_months_and_the_last_may_be_partial(spark, cleaned, rows):
    assert [r[0] for r in rows(months.monthly_revenue(cleaned))] == ["2010-12", "2011-02"]
    flags = dict(rows(months.monthly_revenue_with_partial_flag(cleaned), "YearMonth", "is_partial"))
    assert flags == {"2010-12": False, "2011-02": False}
    early = lines_of(spark, [("1", "a", 5, 1.0, JAN), ("2", "a", 5, 1.0, FEB)])
    flags = months.monthly_revenue_with_partial_flag(rules.clean(early))
    assert dict(rows(flags, "YearMonth", "is_partial")) == {"2011-01": False, "2011-02": True}


def test_top_products_rank_by_line_count_over_all_products(spark, rows):
    lines = rules.clean(
        lines_of(
            spark,
            [("1", "a", 100, 1.0, JAN), ("2", "b", 1, 1.0, JAN), ("3", "b", 1, 1.0, JAN), ("4", "c", 2, 1.0, JAN),
             ("5", "c", 2, 1.0, JAN), ("6", "POSTAGE", 900, 1.0, JAN)],
        )
    )
    got = [tuple(r) for r in q3.top_products(q3.products_of(lines), 2).collect()]
    assert got == [("a", 100.0, 3), ("c", 4.0, 1)]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 11])
def test_pareto_summary_of_few_products(spark, n):
    lines = rules.clean(lines_of(spark, [(str(i), f"p{i:02}", 10, 1.0, JAN) for i in range(n)]))
    products = q3.products_of(lines)
    got = q3.pareto_summary(products).first()
    cut = max(1, n // 5)
    needed = next(k for k in range(1, n + 1) if k * 10 / (n * 10) * 100 >= 80)
    assert (got.TotalProducts, got.TopFifthCount, got.ProductsFor80) == (n, cut, needed)
    assert got.TopFifthShare_pct == pytest.approx(cut / n * 100)
    assert got.PlottedProducts == min(n, max(int(n * 0.3), int(needed * 1.2)))
    # Equal revenues are still numbered and added up one by one.
    curve = q3.pareto_curve(products).orderBy("product_rank").collect()
    assert [r.cumulative_revenue for r in curve] == [10.0 * k for k in range(1, n + 1)]


def test_order_thresholds_are_strict_and_default_to_the_report_sizes(spark, rows):
    lines = rules.clean(
        lines_of(spark, [("1", "a", 500, 1.0, JAN), ("2", "a", 500.5, 1.0, JAN), ("3", "a", 12000, 1.0, JAN)])
    )
    got = rows(q4.large_order_impact(q4.invoices_of(lines)))
    assert [r[:3] for r in got] == [(500, 2, 66.67), (1000, 1, 33.33), (5000, 1, 33.33), (10000, 1, 33.33)]
    assert got[0][3] == 12500.5


def test_orders_without_a_number_are_no_orders(cleaned, rows):
    assert None not in {r[0] for r in rows(q4.invoices_of(cleaned))}


def test_customer_value(cleaned, rows):
    got = [tuple(r) for r in q5.customer_value(customer_grain(visit_grain(cleaned))).collect()]
    # 12346: two numbered invoices; the line without a number counts for revenue only.
    assert got[0] == (12346, 72.0 , 2, 36.0)


def test_vips_lie_strictly_above_both_medians(spark, rows):
    values = []
    for customer, spent, orders in ((1, 10, 1), (2, 20, 2), (3, 30, 3), (4, 40, 1), (5, 5, 4)):
        values += [(f"{customer}-{i}", "a", spent / orders, float(customer), JAN) for i in range(orders)]
    visits = q5.visits_of(rules.clean(lines_of(spark, [(i.replace("-", ""), *rest) for i, *rest in values])))
    customers = q5.customers_of(visits)
    assert rows(q5.vip_ids(customers)) == [(3,)]
    segments = dict(rows(charts.customer_segments(customers, 2), "CustomerID", "Segment"))
    # On the median is low: customer 2 sits on both.
    assert segments == {1: "Casual", 2: "Casual", 3: "VIP", 4: "Big Spender", 5: "Loyal Small Buyer"}
    assert q5.customer_pareto(customers).first()[:2] == (5, 1)


def test_one_customer_and_flat_season(spark, rows):
    lines = rules.clean(lines_of(spark, [("1", "a", 5, 1.0, JAN), ("2", "a", 5, 1.0, FEB)]))
    visits = q5.visits_of(lines)
    customers = q5.customers_of(visits)
    assert tuple(q5.customer_pareto(customers).first()) == (1, 1, 100.0)
    season = rows(q5.vip_season(visits, customers), "YearMonth", "vip_norm", "non_vip_norm")
    assert {r.VIPs for r in q5.vip_season(visits, customers).collect()} == {0}
    assert season == [("2011-01", None, 0.0), ("2011-02", None, 0.0)]


def test_no_lines_give_empty_frames_and_null_shares(spark):
    nothing = rules.clean(edge_lines(spark)).limit(0)
    assert markets.country_revenue(nothing).count() == 0
    assert months.monthly_revenue(nothing).count() == 0
    assert q3.pareto(q3.products_of(nothing)).count() == 0
    assert {r.OrderPct for r in q4.large_order_impact(q4.invoices_of(nothing)).collect()} == {None}
    customers = q5.customers_of(q5.visits_of(nothing))
    assert q5.customer_pareto(customers).first().total_customers == 0
    assert charts.histogram(q4.invoices_of(nothing), "OrderValue").count() == 0


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    invoices = spark.createDataFrame([(str(i), float(v)) for i, v in enumerate([0, 1, 59.9, 60])], "InvoiceNo string, OrderValue double")
    bins = {r.Bin: r.n for r in charts.histogram(invoices.unionByName(invoices), "OrderValue").collect()}
    assert len(bins) == 60 and sum(bins.values()) == 8
    assert bins[0] == 2 and bins[1] == 2 and bins[59] == 4 and bins[30] == 0
    flat = spark.createDataFrame([("1", 5.0), ("2", 5.0)], "InvoiceNo string, OrderValue double")
    assert sum(r.n for r in charts.histogram(flat, "OrderValue").collect()) == 2


# What must hold between the results on any data.
def test_results_agree_with_each_other(spark):
    lines = rules.clean(sales_lines(spark, "/root/testdata/sf0.001")).cache()
    everything = lines.selectExpr("double(sum(cast(Revenue AS decimal(24,6))))").first()[0]
    by_month = sum(r.Revenue for r in months.monthly_revenue(lines).collect())
    split = {r.Label: r.Revenue for r in markets.uk_vs_others(lines).collect()}
    invoices = q4.invoices_of(lines)
    assert by_month == pytest.approx(everything) and sum(split.values()) == pytest.approx(everything)
    assert sum(r.OrderValue for r in invoices.collect()) == pytest.approx(everything)
    for r in markets.country_revenue(lines).collect():
        assert r.RevenueShare_pct == pytest.approx(r.Revenue / everything * 100, abs=0.0051)
    impact = q4.large_order_impact(invoices, (100, 200, 400)).collect()
    assert sorted((r.OrderCount for r in impact), reverse=True) == [r.OrderCount for r in impact]
    for r in q5.customer_value(customer_grain(visit_grain(lines))).collect():
        assert r.AvgOrderValue == r.TotalRevenue / r.OrderCount
    lines.unpersist()
