"""Small jobs with values that can be followed by hand.

Fixed values: the inputs and results of the worked examples.
"""

from datetime import datetime

import pytest


from ledgerlark.jobs import logs, people, rankings, reconcile, scalars
from ledgerlark.operators import select, sequences, sets
from ledgerlark.operators.graph import reachable_from
from ledgerlark.plans.months import growth_between


def test_contacts(spark, rows):
    raw = spark.createDataFrame(
        [("  KIM, song   ", "kim.song@email.com  "), ("lee, jun", "leejunATemail.com"), ("  Park, Min  ", "park.min@email.com")],
        "raw_name string, raw_email string",
    )
    assert rows(people.normalise_contacts(raw)) == [
        ("Kim", "Song", "kim.song@email.com", True),
        ("Lee", "Jun", "leejunatemail.com", False),
        ("Park", "Min", "park.min@email.com", True),
    ]


def test_validated_load(spark, rows):
    batch = spark.createDataFrame(
        [("Robin", "28", "b@x"), ("Kim", "abc", "k@x"), ("", "35", "n@x"), ("Park", " 41 ", "p@x"), ("", "abc", None),
         (None, "1", None), ("Lee", "3.7", None), ("Choi", None, None)],
        "name string, age string, email string",
    )
    assert rows(people.accepted(batch), "name", "age") == [("Park", 41), ("Robin", 28)]
    reasons = [(r.name, r.reason) for r in people.quarantined(batch).collect()]
    assert sorted(reasons, key=str) == sorted(
        [("Kim", "parsing error"), ("", "validation error"), ("", "validation error"), (None, "validation error"),
         ("Lee", "parsing error"), ("Choi", "parsing error")],
        key=str,
    )
    assert rows(people.load_summary(batch)) == [(2, 6)]
    emails = spark.createDataFrame([(None,), ("not-an-email",), ("ok@example.com",)], "email string")
    assert rows(people.with_email_reason(emails), "reason") == [(None,), ("InvalidFormatError",), ("MissingFieldError",)]


def test_reconciliation(spark, rows):
    crm = spark.createDataFrame([(1, "Kim"), (2, "Lee"), (3, "Park")], "cid int, name string")
    billing = spark.createDataFrame([(2,), (3,), (3,), (4,)], "cid int")
    assert [tuple(r) for r in reconcile.mismatches(crm, billing, "cid", "name").collect()] == [
        (1, "Kim", "missing_from_billing"),
        (4, "Unknown", "missing_from_crm"),
    ]
    names = spark.createDataFrame([("PRJ-101", "Website")], "code string, name string")
    codes = spark.createDataFrame([("PRJ-101",), ("PRJ-104",)], "code string")
    assert rows(select.with_lookup(codes, names, "code", "name", "Unnamed Project")) == [
        ("PRJ-101", "Website"), ("PRJ-104", "Unnamed Project"),
    ]
    defaults = spark.createDataFrame([("theme", "light"), ("size", "10")], "k string, v string")
    prefs = spark.createDataFrame([("theme", "dark"), ("lang", "ko")], "k string, v string")
    assert rows(reconcile.layered(defaults, prefs, "k", "v")) == [("lang", "ko"), ("size", "10"), ("theme", "dark")]


def test_campaigns(spark):
    campaigns = spark.createDataFrame(
        [("Spring Sale", 2000.0, 8000.0), ("Email Blast", 300.0, 2400.0), ("Influencer", 1500.0, 3000.0),
         ("Retargeting", 600.0, 3600.0), ("Unpaid", 0.0, 10.0)],
        "name string, spend double, revenue double",
    )
    ranked = [tuple(r) for r in rankings.roi_ranking(campaigns).orderBy("rank").collect()]
    assert ranked == [(1, "Email Blast", 7.0), (2, "Retargeting", 5.0), (3, "Spring Sale", 3.0), (4, "Influencer", 1.0), (5, "Unpaid", None)]
    assert tuple(rankings.roi_summary(campaigns).first()) == (4400.0, "Email Blast", 7.0)


def test_work_queue(spark):
    tickets = spark.createDataFrame(
        [(1, "T1", 2, "open"), (2, "T2", 1, "cancelled"), (3, "T3", 3, "open"), (4, "T4", 1, "open"), (5, "T5", 1, None)],
        "pos int, id string, priority int, status string",
    )
    queue = rankings.work_queue(tickets, "pos", "priority", "status = 'cancelled'")
    assert [r.id for r in queue.orderBy("place").collect()] == ["T4", "T5", "T3"]


def test_log_lines(spark):
    lines = spark.createDataFrame(
        [(1, "2024-01-15 10:02:11 status=200 path=/home"), (2, "2024-01-15 10:02:14 status=404 path=/missing"),
         (3, "2024-01-15 10:02:20 status=200 path=/home"), (4, "2024-01-15 10:03:01 status=500 path=/api/orders"),
         (5, "2024-01-15 10:03:05 status=200 path=/home")],
        "pos int, value string",
    )
    odd = lines.unionByName(spark.createDataFrame([(6, "2024-01-15 10:04:00 status=12345 path=/x"), (7, "no status")], "pos int, value string"))
    assert dict(map(tuple, logs.status_counts(odd).collect())) == {"200": 3, "404": 1, "500": 1, "other": 1, "": 1}
    got = logs.log_summary(lines, "pos").first()
    assert (got.total_requests, got.error_rate) == (5, 0.4)
    assert got.first_event == "January 15, 2024 at 10:02:11"
    assert got.summary == (
        '{"total_requests":5,"status_breakdown":{"200":3,"404":1,"500":1},"error_rate":0.4}'
    )


def test_filters_labels_and_tiers(spark, rows):
    sales = spark.createDataFrame(
        [("West", 500, "completed"), ("East", 300, "completed"), ("West", 150, "pending"), ("East", 700, "completed"), (None, 1, None)],
        "region string, amount int, status string",
    )
    assert rows(select.where_equal(sales, region="West", status="completed"), "amount") == [(500,)]
    assert rows(select.where_equal(sales, region=None), "amount") == [(1,)]
    assert select.where_equal(sales, colour="red").count() == 0
    assert rows(select.conditional_summary(sales, "coalesce(status = 'completed', false)", "amount")) == [(5, 3, 1500.0)]
    coded = spark.createDataFrame([(1, 120.0), (9, 45.5), (None, 50.0)], "status int, amount double")
    labelled = select.with_label(coded, "status", {1: "Paid", 2: "Pending"}, "label")
    assert rows(select.with_discount(labelled, "amount"), "label", "discount") == [
        ("Paid", 0.10), ("Unknown", 0.0), ("Unknown", 0.05),
    ]
    text = spark.createDataFrame([("Robin,1200",), ("Kim,450",), ("Lee,780",), ("Park,50",)], "value string")
    assert [(r.name, r.tier) for r in select.customers_from_text(text).collect()] == [
        ("Robin", "Gold"), ("Lee", "Silver"), ("Kim", "Bronze"), ("Park", "Bronze"),
    ]
    taxed = spark.createDataFrame([(150000.0,), (320000.0,), (80000.0,), (450000.0,), (210000.0,)], "a double")
    assert select.with_tax(taxed, "a", 0.1, 300_000).filter("is_vip").count() == 2


def test_first_rows_extremes_flags(spark, rows):
    values = spark.createDataFrame([(0, 3), (1, 7), (2, 1), (3, 9), (4, 9), (5, 1)], "pos int, v int")
    assert rows(select.first_row_where(values, "v > 6", "pos")) == [(1, 7)]
    assert rows(select.first_row_where(values, "v > 60", "pos")) == [(None, None)]
    assert rows(select.extremes_with_position(values, "v", "pos")) == [(9, 3, 1, 2)]
    assert rows(select.any_and_all(values.limit(0), "v > 0", "v > 0")) == [(False, True)]
    votes = spark.createDataFrame(list(enumerate(["cat", "dog", "cat", "bird", "dog", "cat", "ant"])), "pos int, v string")
    assert [r.v for r in sequences.most_common(votes, "v", "pos", 4).collect()] == ["cat", "dog", "bird", "ant"]
    assert [r.v for r in sequences.first_seen(votes, "v", "pos").collect()] == ["cat", "dog", "bird", "ant"]
    grid = select.grid_counts(votes, {"v": ["cat", "cow"]})
    assert rows(grid) == [("cat", 3), ("cow", 0)]


def test_sets(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "x int")
    b = spark.createDataFrame([(2,), (4,)], "x int")
    assert rows(sets.union_of(a, b)) == [(1,), (2,), (3,), (4,)]
    assert rows(sets.intersection_of(a, b)) == [(2,)]
    assert rows(sets.difference_of(a, b)) == [(1,), (3,)]
    assert rows(sets.symmetric_difference_of(a, b)) == [(1,), (3,), (4,)]
    assert rows(sets.concatenation_of(a, b)) == [(1,), (2,), (2,), (2,), (3,), (4,)]
    assert rows(sets.set_relations(a, b)) == [(False, False, False)]
    assert rows(sets.set_relations(b.limit(0), a)) == [(True, False, True)]
    assert rows(sets.set_relations(a, a.distinct())) == [(True, True, False)]
    assert rows(sets.added_counts(a, b, "x")) == [(1, 1), (2, 3), (3, 1), (4, 1)]
    assert rows(sets.remaining_counts(a, b, "x")) == [(1, 1), (2, 1), (3, 1)]
    placed = spark.createDataFrame([(0, 1), (1, 2), (2, 1), (3, 5), (4, 4)], "pos int, x int")
    assert [r.x for r in sets.ordered_difference(placed, b, "x", "pos").collect()] == [1, 1, 5]


def test_samples_repeat(spark):
    frame = spark.range(1000)
    first = [r.id for r in select.sample_rows(frame, "id", 10, 42).collect()]
    assert first == [r.id for r in select.sample_rows(frame.repartition(7), "id", 10, 42).collect()]
    assert len(set(first)) == 10 and first != [r.id for r in select.sample_rows(frame, "id", 10, 43).collect()]
    order = [r.position for r in sequences.shuffled(frame, "id", 1, ranges=4).collect()]
    assert sorted(order) == list(range(1, 1001))


def test_growth(spark, rows):
    quarters = spark.createDataFrame(
        [("West", 480.0, 400.0), ("East", 300.0, 300.0), ("North", 150.0, 0.0), ("South", 90.0, 120.0)],
        "region string, current double, previous double",
    )
    assert dict(rows(rankings.quarter_growth(quarters), "region", "growth")) == {
        "West": 0.2, "East": 0.0, "North": None, "South": -0.25,
    }
    months = spark.createDataFrame([("2010-12", 823746.14), ("2011-11", 1508540.82)], "YearMonth string, Revenue double")
    assert growth_between(months, "2010-12", "2011-11").first().GrowthRate == pytest.approx(0.8313, abs=1e-4)


def test_reachability(spark, rows):
    edges = spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "D"), ("C", "D"), ("D", "A"), ("X", "Y")], "src string, dst string")
    start = spark.createDataFrame([("A",)], "node string")
    assert rows(reachable_from(edges, start)) == [("A", 0), ("B", 1), ("C", 1), ("D", 2)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(10)], "src int, dst int")
    assert len(rows(reachable_from(chain, spark.createDataFrame([(0,)], "node int")))) == 11


def test_scalars(spark):
    text = spark.createDataFrame([(42, "  hello World-7 ")], "id int, t string")
    got = scalars.text_normalise(text, "id", "t").first()
    assert got.title == "  Hello World-7 " and got.swapped == "  HELLO wORLD-7 " and got.zero_filled == "000042"
    assert got.capitalized == "  hello world-7 " and got.digits_or_default == "7" and got.decodes_back
    long = spark.createDataFrame([(1234567, "x" * 40)], "id int, t string")
    got = scalars.text_normalise(long, "id", "t").first()
    assert got.padded == "x" * 40 and got.zero_filled == "1234567" and got.digits_or_default == "Anonymous"
    number = spark.createDataFrame([(4993, 2500.0)], "id bigint, a double")
    got = scalars.number_math(number, "id", "a").first()
    assert (got.floor_quotient, got.floor_remainder, got.thousands) == (-1, 0, 2.0)
    moment = spark.createDataFrame([(1, datetime(2024, 1, 15, 10, 2))], "id int, m timestamp")
    got = scalars.date_parts(moment, "id", "m").first()
    assert (got.weekday, got.long_text, str(got.in_thirty_days)) == (0, "January 15, 2024", "2024-02-14")
    kinds = spark.createDataFrame([("West", 480.0, "domestic"), ("Moon", 1.0, "lunar")], "r string, a double, k string")
    lines = {r.r: r.line for r in scalars.formatted_by_kind(kinds, "r", "a", "k").collect()}
    assert lines == {"West": "West (domestic): $480.00", "Moon": None}
    words = spark.createDataFrame([(1, "blue bolt red")], "id int, w string")
    got = scalars.array_map_ops(words, "id", "w").first()
    assert (got.positions_of_b, got.every_second, got.total_length) == ("0,1", "blue red", 11)
    assert (got.red_or_zero, got.merged_red, got.nested_value) == (3, 16, 3)
    events = spark.createDataFrame([(1, 8, "error", '{"k": 69}'), (2, 8, "view", "{}")], "event_id int, user_id int, event_type string, props string")
    got = {r.event_id: (r.k, r.twice, r.record) for r in scalars.json_roundtrip(events).collect()}
    assert got[1] == (69, 138, '{"user_id":8,"event_type":"error","props":{"k":69}}') and got[2][:2] == (None, 0)


def test_tidy(spark, rows):
    frame = spark.createDataFrame([(1, "7", "x"), (2, "7", "x"), (3, "n/a", "x")], "id int, n string, t string")
    tidied = select.tidy(frame, drop=["id"], rename={"t": "text"}, cast={"n": "int"})
    assert rows(tidied, "n", "text") == [(None, "x"), (7, "x")]
