"""Registered table jobs on orders, customers, events and the other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.catalog.sql import money, query
from ledgerlark.functions import MONEY, exact_sum
from ledgerlark.jobs import logs, people, rankings, reconcile
from ledgerlark.operators import clean as rules, profile, select, sequences, sets
from ledgerlark.operators.graph import reachable_from

from ledgerlark.operators.settle import scratch_path, settle
from ledgerlark.plans import months
from ledgerlark.sources import (
    append_lines,
    load_raw,
    load_with_quarantine,
    read_lines,
    read_text_rows,
    sales_lines,
    table,
    write_csv,
    write_json,
)

# Fixed values.
STATUS = {"F": "Fulfilled", "P": "Pending"}


# --- sources and sinks --------------------------------------------------------------


def sales_lines_through_csv(spark, sf_dir):
    """All lines written as CSV and loaded again with the declared schema."""
    path = f"{scratch_path(spark)}/lines.csv"
    write_csv(sales_lines(spark, sf_dir), path)
    return load_raw(spark, path)


def sales_lines_with_line_breaks(spark, sf_dir):
    """Lines whose descriptions hold line breaks, quotes and commas, through packed CSV."""
    path = f"{scratch_path(spark)}/lines"
    broken = F.expr("Description || '\\n\"2nd\", ' || StockCode")
    lines = sales_lines(spark, sf_dir).withColumn(
        "Description", F.when(F.expr("Quantity % 5 = 0"), broken).otherwise(F.col("Description"))
    )
    write_csv(lines, path, compression="gzip")
    return load_raw(spark, path, file_format="csv", multi_line=True)


_REFUSED = "o_orderkey % 9 IN (4, 5)"


def lines_of_dirty_csv(spark, sf_dir):
    """A CSV in which some lines do not fit their columns: those go to the quarantine."""
    path = f"{scratch_path(spark)}/lines.csv"
    write_csv(
        table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey AS InvoiceNo", "o_custkey AS StockCode", "o_orderpriority AS Description",
            "CASE o_orderkey % 9 WHEN 4 THEN 'six' ELSE string(o_custkey) END AS Quantity",
            "CASE o_orderkey % 9 WHEN 5 THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS InvoiceDate",
            "'2.5' AS UnitPrice", "string(o_custkey) || '.0' AS CustomerID", "o_orderstatus AS Country",
        ),
        path,
    )
    lines, refused = load_with_quarantine(spark, path)
    good = lines.selectExpr("'accepted' AS part", "concat_ws(',', InvoiceNo, Quantity, CustomerID, Country) AS line")
    return good.unionByName(refused.selectExpr("reason AS part", "record AS line"))


def lines_of_a_table(spark, sf_dir):
    """Lines kept as a table of the catalog, loaded by its name."""
    sales_lines(spark, sf_dir).createOrReplaceTempView("sales_lines_at_hand")
    return load_raw(spark, "sales_lines_at_hand", file_format="table").select("InvoiceNo", "StockCode", "UnitPrice")


def text_rows_appended(spark, sf_dir):
    """Rows written as CSV, more appended, all read back as text and cast."""
    path = scratch_path(spark)
    people_rows = table(spark, sf_dir, "customer").selectExpr("c_name AS name", "c_custkey AS age")
    extra = table(spark, sf_dir, "supplier").selectExpr("s_name AS name", "s_suppkey AS age")
    write_csv(people_rows, path)
    write_csv(extra, path, mode="append")
    rows = read_text_rows(spark, path, ["name", "age"])
    return rows.selectExpr("name", "age", "try_cast(age AS bigint) AS age_number")


def lines_appended(spark, sf_dir):
    path = scratch_path(spark)
    append_lines(table(spark, sf_dir, "nation"), path, "n_name")
    append_lines(table(spark, sf_dir, "customer"), path, "c_name")
    return read_lines(spark, path).selectExpr("trim(value) AS line")


def summary_as_json(spark, sf_dir):
    path = scratch_path(spark)
    """The whole summary with its nested breakdown, written and read back."""
    breakdown = F.from_json(F.get_json_object("summary", "$.status_breakdown"), "map<string,bigint>")
    summary = logs.log_summary(_log_lines(spark, sf_dir), "event_id")
    write_json(summary.select("total_requests", breakdown.alias("status_breakdown"), "error_rate"), path)
    read = spark.read.schema(
        "total_requests bigint, status_breakdown map<string,bigint>, error_rate double"
    ).json(path)
    return read.selectExpr("total_requests", "error_rate", "to_json(status_breakdown) AS status_breakdown")


# --- people -------------------------------------------------------------------------


def _contacts(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "'  ' || upper(c_mktsegment) || 'O''NEIL-smith ,  ' || lower(c_name) || '   ' AS raw_name",
        """IF(c_custkey % 5 = 0, 'user' || c_custkey || 'ATmail.com',
              '  User' || c_custkey || '@Mail.COM  ') AS raw_email""",
    )


def _applicants(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "IF(c_custkey % 11 = 0, '', c_name) AS name",
        "IF(c_custkey % 7 = 0, 'abc', string(c_custkey % 60 + 18)) AS age",
        """CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'not-an-email'
                ELSE lower(c_mktsegment) || '@example.com' END AS email""",
    )


def normalised_contacts(spark, sf_dir):
    return people.normalise_contacts(_contacts(spark, sf_dir))


def accepted_rows(spark, sf_dir):
    return people.accepted(_applicants(spark, sf_dir))


def quarantined_rows(spark, sf_dir):
    return people.quarantined(_applicants(spark, sf_dir))


def load_summary(spark, sf_dir):
    return people.load_summary(_applicants(spark, sf_dir))


def accepted_and_quarantined_tables(spark, sf_dir):
    """Both tables written, read back and counted."""
    folder = scratch_path(spark)
    people.write_validated(_applicants(spark, sf_dir), f"{folder}/good", f"{folder}/bad")
    good = spark.read.parquet(f"{folder}/good").selectExpr("'good' AS part", "name")
    bad = spark.read.parquet(f"{folder}/bad").selectExpr("'bad' AS part", "name")
    return good.unionByName(bad).groupBy("part").agg(F.count("name").alias("n"))


def email_reasons(spark, sf_dir):
    rows = people.with_email_reason(_applicants(spark, sf_dir))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def customer_tiers(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_name || ',' || c_acctbal AS value")
    return select.customers_from_text(rows)


# --- orders -------------------------------------------------------------------------


def order_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "o_orderstatus", "IF(o_totalprice > 250000, 'high_value', 'standard') AS flag"
    )
    labelled = select.with_label(orders, "o_orderstatus", STATUS, "label")
    return labelled.selectExpr(
        "o_orderkey",
        "flag",
        "label",
        "format_string('#%d $%10.2f [%-10s] %s', o_orderkey, o_totalprice, flag, label) AS line",
    )


def order_discounts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_totalprice / 2500 AS amount")
    return select.with_discount(orders, "amount").select("o_orderkey", "discount")


def orders_by_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    wanted = select.where_equal(orders, o_orderstatus="F", o_orderpriority="1-URGENT")
    return wanted.select("o_orderkey", "o_custkey", "o_totalprice")


def orders_with_tax(spark, sf_dir):
    taxed = select.with_tax(table(spark, sf_dir, "orders"), "o_totalprice", 0.1, 300_000)
    return taxed.selectExpr("o_orderkey", "round(with_tax, 4) AS with_tax", "is_vip")


def tax_summary(spark, sf_dir):
    taxed = select.with_tax(table(spark, sf_dir, "orders"), "o_totalprice", 0.1, 300_000)
    return taxed.agg(
        F.count_if("is_vip").alias("vips"),
        F.round(F.try_divide(exact_sum("o_totalprice"), F.count("o_totalprice")), 4).alias("average"),
        exact_sum(F.when(F.col("is_vip"), F.col("o_totalprice"))).alias("vip_amount"),
    )


def tidy_events(spark, sf_dir):
    return select.tidy(
        table(spark, sf_dir, "events"),
        drop=["event_id", "ts", "value", "props"],
        rename={"user_id": "user"},
        cast={"user": "string"},
    )


def fulfilled_orders(spark, sf_dir):
    return select.conditional_summary(table(spark, sf_dir, "orders"), "o_orderstatus = 'F'", "o_totalprice")


def first_large_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return select.first_row_where(orders, "o_totalprice > 499000", "o_orderkey")


def price_statistics(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "double(sum(cast(l_extendedprice AS decimal(24,6)))) AS total",
        "round(double(sum(cast(l_extendedprice AS decimal(24,6)))) / count(l_extendedprice), 4) AS mean",
        "max(l_extendedprice) AS largest",
        "min(l_extendedprice) AS smallest",
    )


def priority_status_grid(spark, sf_dir):
    """Status ``X`` is asked for although no order has it: its cells hold zero."""
    return select.grid_counts(
        table(spark, sf_dir, "orders"),
        {
            "o_orderstatus": ["F", "O", "P", "X"],
            "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
        },
    )


def order_queue(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return rankings.work_queue(orders, "o_orderkey", "o_orderpriority", "o_orderstatus = 'P'")


def order_sample(spark, sf_dir):
    return select.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100, 42)


def orders_shuffled(spark, sf_dir):
    return sequences.shuffled(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 42)


# --- two sources --------------------------------------------------------------------


def _crm(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_acctbal > 0").selectExpr("c_custkey AS cid", "c_name AS name")


def _billing(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").selectExpr("o_custkey AS cid")


def reconciliation(spark, sf_dir):
    return reconcile.reconcile(_crm(spark, sf_dir), _billing(spark, sf_dir), "cid", "name")


def reconciliation_mismatches(spark, sf_dir):
    return reconcile.mismatches(_crm(spark, sf_dir), _billing(spark, sf_dir), "cid", "name")


def document_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return select.with_lookup(documents, table(spark, sf_dir, "labels"), "doc_id", "quality", -1)


def layered_quality(spark, sf_dir):
    defaults = table(spark, sf_dir, "documents").selectExpr("doc_id", "int(n_chars >= 500) AS quality")
    return reconcile.layered(defaults, table(spark, sf_dir, "labels"), "doc_id", "quality")


def events_of_other_users(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    big = events.filter("value > 200")
    return sets.ordered_difference(events.select("event_id", "user_id"), big, "user_id", "event_id")


def _urgent(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey")


def _relaxed(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderpriority = '5-LOW'").select("o_custkey")


def customers_in_either(spark, sf_dir):
    return sets.union_of(_urgent(spark, sf_dir), _relaxed(spark, sf_dir))


def customers_in_both(spark, sf_dir):
    return sets.intersection_of(_urgent(spark, sf_dir), _relaxed(spark, sf_dir))


def customers_only_urgent(spark, sf_dir):
    return sets.difference_of(_urgent(spark, sf_dir), _relaxed(spark, sf_dir))


def customers_only_relaxed(spark, sf_dir):
    return sets.difference_of(_relaxed(spark, sf_dir), _urgent(spark, sf_dir))


def customers_in_one(spark, sf_dir):
    return sets.symmetric_difference_of(_urgent(spark, sf_dir), _relaxed(spark, sf_dir))


def customer_set_relations(spark, sf_dir):
    everyone = table(spark, sf_dir, "orders").select("o_custkey")
    return sets.set_relations(_urgent(spark, sf_dir), everyone)


def customers_concatenated(spark, sf_dir):
    return sets.concatenation_of(_urgent(spark, sf_dir), _relaxed(spark, sf_dir))


def distinct_order_states(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


def _events_of(spark, sf_dir, kind):
    return table(spark, sf_dir, "events").filter(F.col("event_type") == kind).select("user_id")


def user_counts_added(spark, sf_dir):
    return sets.added_counts(_events_of(spark, sf_dir, "purchase"), _events_of(spark, sf_dir, "view"), "user_id")


def user_counts_remaining(spark, sf_dir):
    return sets.remaining_counts(_events_of(spark, sf_dir, "purchase"), _events_of(spark, sf_dir, "view"), "user_id")


# --- events -------------------------------------------------------------------------


def _log_lines(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """date_format(ts, 'yyyy-MM-dd HH:mm:ss') || ' status=' ||
           CASE WHEN event_type = 'error' THEN IF(event_id % 2 = 0, '404', '500')
                WHEN event_type = 'signup' THEN '201' ELSE '200' END || ' path=/' || event_type AS value""",
    )


def log_status_counts(spark, sf_dir):
    return logs.status_counts(_log_lines(spark, sf_dir))


def log_summary(spark, sf_dir):
    return logs.log_summary(_log_lines(spark, sf_dir), "event_id")


def most_active_users(spark, sf_dir):
    return sequences.most_common(table(spark, sf_dir, "events"), "user_id", "event_id", 5)


def users_in_order_of_arrival(spark, sf_dir):
    return sequences.first_seen(table(spark, sf_dir, "events"), "user_id", "event_id")


def user_flags(spark, sf_dir):
    return select.any_and_all(table(spark, sf_dir, "events"), "event_type = 'error'", "value < 300", ["user_id"])


def flags_of_no_rows(spark, sf_dir):
    """No event has a negative value: nothing of nothing, everything of nothing."""
    nothing = table(spark, sf_dir, "events").filter("value < 0")
    return select.any_and_all(nothing, "event_type = 'error'", "value > 0")


def value_extremes(spark, sf_dir):
    return select.extremes_with_position(table(spark, sf_dir, "events"), "value", "event_id", ["event_type"])


def event_windows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    runs = sequences.sliding_windows(events, "user_id", ["ts", "event_id"], "event_type", 3)
    return runs.select("user_id", "position", F.array_join("window", ",").alias("types"))


def running_event_values(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr("event_id", "ts", "user_id", "1 + value / 10000 AS factor")
    running = sequences.running_values(events, "user_id", ["ts", "event_id"], "factor")
    return running.selectExpr(
        "event_id", "user_id", "position", "round(running_sum, 9) AS running_sum", "running_max",
        "round(running_product, 6) AS running_product",
    )


def event_runs(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return sequences.consecutive_runs(events, "user_id", ["ts", "event_id"], "event_type")


# --- rankings, growth, pairs --------------------------------------------------------


def _brands(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    # Lines fold to parts before anything is joined, so a part that sells often is one row.
    sold = lines.groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.sum(F.expr("l_extendedprice * (1 - l_discount)").cast(MONEY)).alias("revenue"),
    )
    return (
        sold.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_brand").alias("name"))
        .agg(
            exact_sum(F.expr("quantity * p_retailprice")).alias("spend"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
    )


def brand_roi_ranking(spark, sf_dir):
    return rankings.roi_ranking(_brands(spark, sf_dir)).withColumn("roi", F.round("roi", 6))


def brand_roi_summary(spark, sf_dir):
    return rankings.roi_summary(_brands(spark, sf_dir)).withColumn("best_roi", F.round("best_roi", 6))


def _region_orders(spark, sf_dir):
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    buyers = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))


def region_monthly_growth(spark, sf_dir):
    monthly = _region_orders(spark, sf_dir).groupBy(
        F.col("r_name").alias("region"), F.date_format("o_orderdate", "yyyy-MM").alias("YearMonth")
    ).agg(exact_sum("o_totalprice").alias("Revenue"))
    return months.month_over_month(monthly, by="region").withColumn("GrowthRate", F.round("GrowthRate", 6))


def region_quarter_growth(spark, sf_dir):
    """Second quarter of 2001 against the first; Africa is taken as opened in the second."""
    half = _region_orders(spark, sf_dir).filter(
        "o_orderdate >= timestamp_ntz'2001-01-01' AND o_orderdate < timestamp_ntz'2001-07-01'"
    )
    in_first = "quarter(o_orderdate) = 1"
    quarters = half.groupBy(F.col("r_name").alias("region")).agg(
        F.coalesce(exact_sum(F.expr(f"IF({in_first}, NULL, o_totalprice)")), F.lit(0.0)).alias("current"),
        F.coalesce(
            exact_sum(F.expr(f"IF({in_first} AND r_name <> 'AFRICA', o_totalprice, NULL)")), F.lit(0.0)
        ).alias("previous"),
    )
    return rankings.quarter_growth(quarters).withColumn("growth", F.round("growth", 9))


def brand_pairs(spark, sf_dir):
    return sequences.pair_counts(_baskets(spark, sf_dir), "l_orderkey", "p_brand")


def product_pairs(spark, sf_dir):
    """Products bought together on two invoices or more."""
    lines = rules.clean(sales_lines(spark, sf_dir)).filter("InvoiceNo IS NOT NULL")
    return sequences.pair_counts(lines, "InvoiceNo", "Description", min_baskets=2)


def brand_pairs_ordered(spark, sf_dir):
    return sequences.pair_counts(_baskets(spark, sf_dir), "l_orderkey", "p_brand", ordered=True)


def _baskets(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")


def customers_by_nation(spark, sf_dir):
    """Members per key as pages of sorted names."""
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_name")
    members = sequences.grouped_members(customers, "c_nationkey", "c_name", page_rows=40)
    return members.select("c_nationkey", "page", F.array_join("members", ",").alias("members"))


def customers_by_balance_size(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return profile.largest_by_size(customers, "c_acctbal", 10, "c_custkey")


def customers_sorted(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal", "c_name")
    return sequences.numbered(customers, ["-c_acctbal", "c_name"], "place")


def part_names_by_length(spark, sf_dir):
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "length(p_name) AS n", "reverse(split(p_name, ' ')) AS backwards"
    )
    placed = sequences.numbered(parts, ["n", "p_partkey"], "place")
    return placed.select("p_partkey", "place", F.array_join("backwards", " ").alias("backwards"))


def reachable_suppliers_and_customers(spark, sf_dir):
    """Who is connected to the first customer through shared suppliers, level by level."""
    trades = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    ).selectExpr("'C' || o_custkey AS c", "'S' || l_suppkey AS s", "o_custkey")
    trades = settle(trades.distinct())
    edges = trades.selectExpr("c AS src", "s AS dst").union(trades.selectExpr("s AS src", "c AS dst"))
    start = trades.agg(F.min("o_custkey").alias("k")).selectExpr("'C' || k AS node")
    return reachable_from(edges, start)


QUERIES = {
    f.__name__: f
    for f in (
        sales_lines_through_csv,
        sales_lines_with_line_breaks,
        lines_of_dirty_csv,
        lines_of_a_table,
        text_rows_appended,
        lines_appended,
        summary_as_json,
        normalised_contacts,
        accepted_rows,
        quarantined_rows,
        load_summary,
        accepted_and_quarantined_tables,
        email_reasons,
        customer_tiers,
        order_labels,
        order_discounts,
        orders_by_filter,
        orders_with_tax,
        tax_summary,
        tidy_events,
        fulfilled_orders,
        first_large_order,
        price_statistics,
        priority_status_grid,
        order_queue,
        order_sample,
        orders_shuffled,
        reconciliation,
        reconciliation_mismatches,
        document_quality,
        layered_quality,
        events_of_other_users,
        customers_in_either,
        customers_in_both,
        customers_only_urgent,
        customers_only_relaxed,
        customers_in_one,
        customer_set_relations,
        customers_concatenated,
        distinct_order_states,
        user_counts_added,
        user_counts_remaining,
        log_status_counts,
        log_summary,
        most_active_users,
        users_in_order_of_arrival,
        user_flags,
        flags_of_no_rows,
        value_extremes,
        event_windows,
        running_event_values,
        event_runs,
        brand_roi_ranking,
        brand_roi_summary,
        region_monthly_growth,
        region_quarter_growth,
        brand_pairs,
        brand_pairs_ordered,
        product_pairs,
        customers_by_nation,
        customers_by_balance_size,
        customers_sorted,
        part_names_by_length,
        reachable_suppliers_and_customers,
    )
}


# --- the same in SQL ----------------------------------------------------------------

_TITLE = (
    "array_to_string(list_transform(regexp_extract_all({0}, '([A-Za-z]+|[^A-Za-z]+)'), "
    "lambda x: upper(x[1:1]) || lower(x[2:])), '')"
)
_CONTACTS = {
    "contacts": """SELECT c_custkey,
  '  ' || upper(c_mktsegment) || 'O''NEIL-smith ,  ' || lower(c_name) || '   ' AS raw_name,
  CASE WHEN c_custkey % 5 = 0 THEN 'user' || c_custkey || 'ATmail.com'
       ELSE '  User' || c_custkey || '@Mail.COM  ' END AS raw_email FROM customer"""
}
_APPLICANTS = {
    "applicants": """SELECT CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS name,
  CASE WHEN c_custkey % 7 = 0 THEN 'abc' ELSE CAST(c_custkey % 60 + 18 AS VARCHAR) END AS age,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'not-an-email'
       ELSE lower(c_mktsegment) || '@example.com' END AS email FROM customer""",
    "judged": """SELECT *, CASE WHEN name = '' THEN 'validation error'
  WHEN TRY_CAST(age AS BIGINT) IS NULL THEN 'parsing error' END AS reason FROM applicants""",
}
_LOG = {
    "log": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' status=' ||
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN '404' ELSE '500' END
       WHEN event_type = 'signup' THEN '201' ELSE '200' END || ' path=/' || event_type AS value FROM events""",
    "seen": "SELECT regexp_extract(value, 'status=([0-9]+)', 1) AS status, count(*) AS n FROM log GROUP BY 1",
}
_RATE = (
    "round_even(CAST((SELECT sum(n) FROM seen WHERE status IN ('404', '500')) AS DOUBLE) "
    "/ (SELECT sum(n) FROM seen), 2)"
)
_RECONCILED = """SELECT coalesce(c.c_custkey, b.o_custkey) AS cid, coalesce(c.c_name, 'Unknown') AS name,
  CASE WHEN b.o_custkey IS NULL THEN 'missing_from_billing'
       WHEN c.c_custkey IS NULL THEN 'missing_from_crm' ELSE 'both' END AS issue
FROM (SELECT * FROM customer WHERE c_acctbal > 0) c
FULL OUTER JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') b ON c.c_custkey = b.o_custkey"""
_U = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"
_R = "SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'"
_BRANDS = {
    "brands": f"""SELECT p_brand AS name, {money('l_quantity * p_retailprice')} AS spend,
  {money('l_extendedprice * (1 - l_discount)')} AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""
}
_REGION_ORDERS = """orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_BASKETS = {
    "baskets": "SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey"
}


def _quarter_sql(name: str) -> str:
    year, quarter = name.split("-Q")
    test = f"year(o_orderdate) = {year} AND quarter(o_orderdate) = {quarter}"
    return f"coalesce({money(f'CASE WHEN {test} THEN o_totalprice END')}, 0)"


ORACLE = {
    "sales_lines_through_csv": query("SELECT * FROM sales", "sales"),
    "sales_lines_with_line_breaks": query(
        """SELECT * REPLACE (CASE WHEN Quantity % 5 = 0 THEN Description || chr(10) || '"2nd", ' || StockCode
                  ELSE Description END AS Description) FROM sales""",
        "sales",
    ),
    "lines_of_dirty_csv": f"""
SELECT 'accepted' AS part,
  concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus) AS line
FROM orders WHERE NOT ({_REFUSED})
UNION ALL
SELECT 'parsing error', concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderpriority,
  CASE WHEN o_orderkey % 9 = 4 THEN 'six' ELSE CAST(o_custkey AS VARCHAR) END,
  CASE WHEN o_orderkey % 9 = 5 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END,
  '2.5', o_custkey || '.0', o_orderstatus)
FROM orders WHERE {_REFUSED}""",
    "lines_of_a_table": query("SELECT InvoiceNo, StockCode, UnitPrice FROM sales", "sales"),
    "text_rows_appended": """SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS age, c_custkey AS age_number
FROM customer UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR), s_suppkey FROM supplier""",
    "lines_appended": "SELECT n_name AS line FROM nation UNION ALL SELECT c_name FROM customer",
    "summary_as_json": query(
        f"""SELECT CAST(sum(n) AS BIGINT) AS total_requests, {_RATE} AS error_rate,
  '{{' || string_agg('"' || status || '":' || n, ',' ORDER BY status) || '}}' AS status_breakdown FROM seen""",
        extra=_LOG,
    ),
    "normalised_contacts": query(
        f"""
SELECT c_custkey, {_TITLE.format("trim(split_part(trim(raw_name), ',', 1))")} AS "last",
       {_TITLE.format("trim(split_part(trim(raw_name), ',', 2))")} AS "first",
       lower(trim(raw_email)) AS email, contains(raw_email, '@') AS is_valid FROM contacts""",
        extra=_CONTACTS,
    ),
    "accepted_rows": query(
        "SELECT name, email, CAST(age AS BIGINT) AS age FROM judged WHERE reason IS NULL", extra=_APPLICANTS
    ),
    "quarantined_rows": query("SELECT * FROM judged WHERE reason IS NOT NULL", extra=_APPLICANTS),
    "load_summary": query(
        """SELECT count(*) FILTER (WHERE reason IS NULL) AS succeeded,
count(*) FILTER (WHERE reason IS NOT NULL) AS failed FROM judged""",
        extra=_APPLICANTS,
    ),
    "accepted_and_quarantined_tables": query(
        "SELECT CASE WHEN reason IS NULL THEN 'good' ELSE 'bad' END AS part, count(*) AS n FROM judged GROUP BY 1",
        extra=_APPLICANTS,
    ),
    "email_reasons": query(
        """SELECT CASE WHEN email IS NULL THEN 'MissingFieldError'
WHEN NOT contains(email, '@') THEN 'InvalidFormatError' END AS reason, count(*) AS n FROM applicants GROUP BY 1""",
        extra=_APPLICANTS,
    ),
    "customer_tiers": """SELECT c_name AS name, c_acctbal AS total_spend,
CASE WHEN c_acctbal >= 1000 THEN 'Gold' WHEN c_acctbal >= 500 THEN 'Silver' ELSE 'Bronze' END AS tier
FROM customer""",
    "order_labels": """SELECT o_orderkey, flag, label,
  printf('#%d $%10.2f [%-10s] %s', o_orderkey, o_totalprice, flag, label) AS line
FROM (SELECT *, CASE WHEN o_totalprice > 250000 THEN 'high_value' ELSE 'standard' END AS flag,
             CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'P' THEN 'Pending' ELSE 'Unknown' END AS label
      FROM orders)""",
    "order_discounts": """SELECT o_orderkey, CAST(CASE WHEN o_totalprice / 2500 >= 100 THEN 0.10
WHEN o_totalprice / 2500 >= 50 THEN 0.05 ELSE 0.0 END AS DOUBLE) AS discount FROM orders""",
    "orders_by_filter": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "orders_with_tax": """SELECT o_orderkey, round(o_totalprice * CAST(1.1 AS DOUBLE), 4) AS with_tax,
o_totalprice >= 300000 AS is_vip FROM orders""",
    "tax_summary": f"""SELECT count(*) FILTER (WHERE o_totalprice >= 300000) AS vips,
round({money('o_totalprice')} / count(*), 4) AS average,
{money('CASE WHEN o_totalprice >= 300000 THEN o_totalprice END')} AS vip_amount FROM orders""",
    "tidy_events": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS \"user\", event_type FROM events",
    "fulfilled_orders": f"""SELECT count(*) AS all_rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS matching,
{money("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END")} AS total FROM orders""",
    "first_large_order": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_totalprice > 499000 ORDER BY o_orderkey LIMIT 1""",
    "price_statistics": f"""SELECT {money('l_extendedprice')} AS total,
round({money('l_extendedprice')} / count(l_extendedprice), 4) AS mean,
max(l_extendedprice) AS largest, min(l_extendedprice) AS smallest FROM lineitem""",
    "priority_status_grid": """SELECT s.v AS o_orderstatus, p.v AS o_orderpriority, count(o_orderkey) AS n
FROM (VALUES ('F'), ('O'), ('P'), ('X')) s(v)
CROSS JOIN (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) p(v)
LEFT JOIN orders ON o_orderstatus = s.v AND o_orderpriority = p.v GROUP BY 1, 2""",
    "order_queue": """SELECT o_orderkey, o_orderpriority, o_orderstatus,
row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS place FROM orders
WHERE o_orderkey <> (SELECT min(o_orderkey) FROM orders) AND o_orderstatus <> 'P'""",
    "order_sample": """SELECT o_orderkey, o_custkey FROM orders
ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 100""",
    "orders_shuffled": """SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || ':42'), o_orderkey)
AS position FROM orders""",
    "reconciliation": _RECONCILED,
    "reconciliation_mismatches": f"SELECT * FROM ({_RECONCILED}) WHERE issue <> 'both'",
    "document_quality": """SELECT doc_id, lang, coalesce(quality, -1) AS quality
FROM documents LEFT JOIN labels USING (doc_id)""",
    "layered_quality": """SELECT doc_id, coalesce(l.quality, CAST(n_chars >= 500 AS INT)) AS quality
FROM documents FULL OUTER JOIN labels l USING (doc_id)""",
    "events_of_other_users": """SELECT event_id, user_id FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 200)""",
    "customers_in_either": f"{_U} UNION {_R}",
    "customers_in_both": f"{_U} INTERSECT {_R}",
    "customers_only_urgent": f"{_U} EXCEPT {_R}",
    "customers_only_relaxed": f"{_R} EXCEPT {_U}",
    "customers_in_one": f"({_U} EXCEPT {_R}) UNION ({_R} EXCEPT {_U})",
    "customer_set_relations": f"""SELECT NOT EXISTS ({_U} EXCEPT SELECT o_custkey FROM orders) AS is_subset,
NOT EXISTS (SELECT o_custkey FROM orders EXCEPT {_U}) AS is_superset,
NOT EXISTS ({_U} INTERSECT SELECT o_custkey FROM orders) AS is_disjoint""",
    "customers_concatenated": f"{_U} UNION ALL {_R}",
    "distinct_order_states": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "user_counts_added": """SELECT user_id, count(*) AS n FROM events
WHERE event_type IN ('purchase', 'view') GROUP BY 1""",
    "user_counts_remaining": """SELECT user_id,
CAST(sum(CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN -1 ELSE 0 END) AS BIGINT) AS n
FROM events GROUP BY 1
HAVING sum(CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN -1 ELSE 0 END) > 0""",
    "log_status_counts": query("SELECT * FROM seen", extra=_LOG),
    "log_summary": query(
        f"""
SELECT CAST(sum(n) AS BIGINT) AS total_requests, {_RATE} AS error_rate,
  (SELECT strftime(CAST(split_part(value, ' status=', 1) AS TIMESTAMP), '%B %d, %Y at %H:%M:%S')
   FROM log ORDER BY event_id LIMIT 1) AS first_event,
  '{{"total_requests":' || sum(n) || ',"status_breakdown":{{' ||
  string_agg('"' || status || '":' || n, ',' ORDER BY status) || '}},"error_rate":' || {_RATE} || '}}' AS summary
FROM seen""",
        extra=_LOG,
    ),
    "most_active_users": """SELECT user_id, count(*) AS n FROM events GROUP BY 1
ORDER BY 2 DESC, min(event_id) LIMIT 5""",
    "users_in_order_of_arrival": "SELECT user_id, min(event_id) AS first_position FROM events GROUP BY 1",
    "user_flags": """SELECT user_id, bool_or(event_type = 'error') AS has_any, bool_and(value < 300) AS has_all
FROM events GROUP BY 1""",
    "flags_of_no_rows": """SELECT coalesce(bool_or(event_type = 'error'), false) AS has_any,
coalesce(bool_and(value > 0), true) AS has_all FROM events WHERE value < 0""",
    "value_extremes": """SELECT event_type, max(value) AS max_value, min(value) AS min_value,
  min(CASE WHEN value = hi THEN event_id END) AS max_position, min(CASE WHEN value = lo THEN event_id END) AS min_position
FROM (SELECT *, max(value) OVER (PARTITION BY event_type) AS hi, min(value) OVER (PARTITION BY event_type) AS lo
      FROM events) GROUP BY 1""",
    "event_windows": """SELECT user_id, position, a || ',' || b || ',' || c AS types
FROM (SELECT user_id, row_number() OVER w AS position, event_type AS a,
             lead(event_type, 1) OVER w AS b, lead(event_type, 2) OVER w AS c
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE c IS NOT NULL""",
    "running_event_values": f"""SELECT event_id, user_id, row_number() OVER w AS position,
  round(sum(1 + value / 10000) OVER w, 9) AS running_sum,
  max(1 + value / 10000) OVER w AS running_max, round(product(1 + value / 10000) OVER w, 6) AS running_product
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "event_runs": """SELECT user_id, event_type, min(p) AS first_position, count(*) AS length
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS q FROM events)
GROUP BY user_id, event_type, p - q""",
    "brand_roi_ranking": query(
        """
SELECT row_number() OVER (ORDER BY (revenue - spend) / spend DESC, name) AS rank, name,
       round((revenue - spend) / spend, 6) AS roi FROM brands""",
        extra=_BRANDS,
    ),
    "brand_roi_summary": query(
        f"""
SELECT {money('spend')} AS total_spend,
       (SELECT name FROM brands ORDER BY (revenue - spend) / spend DESC, name LIMIT 1) AS best,
       round(max((revenue - spend) / spend), 6) AS best_roi FROM brands""",
        extra=_BRANDS,
    ),
    "region_monthly_growth": query(
        """
SELECT region, YearMonth, Revenue, Previous, round((Revenue - Previous) / nullif(Previous, 0), 6) AS GrowthRate
FROM (SELECT *, lag(Revenue) OVER (PARTITION BY region ORDER BY YearMonth) AS Previous FROM monthly)""",
        extra={
            "monthly": f"""SELECT r_name AS region, strftime(o_orderdate, '%Y-%m') AS YearMonth,
  {money('o_totalprice')} AS Revenue FROM {_REGION_ORDERS} GROUP BY 1, 2"""
        },
    ),
    "region_quarter_growth": query(
        """SELECT *, round(CASE WHEN previous <> 0 THEN ("current" - previous) / previous END, 9) AS growth
FROM quarters""",
        extra={
            "quarters": f"""SELECT r_name AS region, {_quarter_sql('2001-Q2')} AS "current",
  CASE WHEN r_name = 'AFRICA' THEN 0 ELSE {_quarter_sql('2001-Q1')} END AS previous
FROM {_REGION_ORDERS} WHERE o_orderdate >= '2001-01-01' AND o_orderdate < '2001-07-01' GROUP BY 1"""
        },
    ),
    "brand_pairs": query(
        """SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS n FROM baskets x
JOIN baskets y ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY 1, 2""",
        extra=_BASKETS,
    ),
    "product_pairs": query(
        """SELECT x.Description AS a, y.Description AS b, count(*) AS n
FROM (SELECT DISTINCT InvoiceNo, Description FROM clean) x
JOIN (SELECT DISTINCT InvoiceNo, Description FROM clean) y
ON x.InvoiceNo = y.InvoiceNo AND x.Description < y.Description GROUP BY 1, 2 HAVING count(*) >= 2""",
        "clean",
    ),
    "brand_pairs_ordered": query(
        """SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS n FROM baskets x
JOIN baskets y ON x.l_orderkey = y.l_orderkey AND x.p_brand <> y.p_brand GROUP BY 1, 2""",
        extra=_BASKETS,
    ),
    "customers_by_nation": """SELECT c_nationkey, CAST((rn - 1) // 40 AS INT) AS page,
  string_agg(c_name, ',' ORDER BY c_name) AS members
FROM (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS rn
      FROM (SELECT DISTINCT c_nationkey, c_name FROM customer)) GROUP BY 1, 2""",
    "customers_by_balance_size": """SELECT c_custkey, c_acctbal FROM customer
ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 10""",
    "customers_sorted": """SELECT c_mktsegment, c_acctbal, c_name,
row_number() OVER (ORDER BY c_acctbal DESC, c_name) AS place FROM customer""",
    "part_names_by_length": """SELECT p_partkey, row_number() OVER (ORDER BY length(p_name), p_partkey) AS place,
array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS backwards FROM part""",
    "reachable_suppliers_and_customers": query(
        """SELECT node, min(level) AS level FROM met GROUP BY node""",
        extra={
            "trades": """SELECT DISTINCT 'C' || o_custkey AS c, 'S' || l_suppkey AS s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
            "edges": "SELECT c AS src, s AS dst FROM trades UNION SELECT s, c FROM trades",
            "m0": "SELECT 'C' || min(o_custkey) AS node FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
            **{
                f"m{i}": f"SELECT DISTINCT dst AS node FROM edges WHERE src IN (SELECT node FROM m{i - 1})"
                for i in range(1, 9)
            },
            "met": " UNION ALL ".join(f"SELECT node, {i} AS level FROM m{i}" for i in range(9)),
        },
    ),
}
