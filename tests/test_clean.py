from fixtures import edge_lines

from ledgerlark.operators import clean as rules, profile


def test_clean_keeps_and_drops_the_right_lines(spark, rows):
    kept = rows(rules.clean(edge_lines(spark)), "InvoiceNo", "Description", "Country")
    assert kept == [
        (None, "MUG", "United Kingdom"),  # a missing invoice number is not a non-sales one
        ("536365", "MUG", "United Kingdom"),
        ("536365", "PAPER CHAIN ", "United Kingdom"),  # blanks are part of the name
        ("536366", "MUG", "Ireland"),
        ("536367", "CUP", "South Africa"),
        ("536369", "POSTAGE", "France"),
        ("536369", "postage", "France"),
        ("536370", None, None),  # a missing country is kept
        ("c1", "CUP", "Ireland"),  # a lower-case c passes like an upper-case one
    ]


def test_each_rule_alone(spark):
    lines = edge_lines(spark)
    assert rules.remove_non_countries(lines).count() == len(lines.collect()) - 2
    assert rules.remove_non_positive_quantity(lines).filter("Quantity IS NULL OR Quantity <= 0").count() == 0
    # NaN counts as missing, so it does not pass as "above zero".
    assert rules.remove_non_positive_price(lines).filter("UnitPrice IS NULL OR isnan(UnitPrice)").count() == 0
    left = {r.InvoiceNo for r in rules.remove_non_sales_invoices(lines).collect()}
    assert {"C536379", "c1", None} <= left and not {"A563185", "B1"} & left


def test_non_products_are_exact_texts(spark, rows):
    left = {r[0] for r in rows(rules.remove_non_products(edge_lines(spark)), "Description")}
    assert None in left and "postage" in left
    assert "POSTAGE" not in left and "Adjust bad debt" not in left


def test_audit_charges_each_line_to_its_first_failing_rule(spark, rows):
    audit = rules.cleaning_audit(edge_lines(spark))
    assert rows(audit, "Rule", "RowsBefore", "RowsDropped", "RowsAfter") == [
        ("positive price", 15, 4, 11),
        ("positive quantity", 18, 3, 15),
        ("real country", 20, 2, 18),
        ("sales invoice", 11, 2, 9),
    ]
    assert rules.clean(edge_lines(spark)).count() == 9
    assert rows(audit.select("CountriesAsWritten", "CountriesNormalised").distinct()) == [(7, 6)]


def test_audit_of_no_lines(spark, rows):
    audit = rules.cleaning_audit(edge_lines(spark).limit(0))
    assert {r[1:4] for r in rows(audit)} == {
        (rule, 0, 0) for rule in ("real country", "positive quantity", "positive price", "sales invoice")
    }


def test_invoice_kinds(spark, rows):
    assert rows(profile.invoice_kinds(edge_lines(spark))) == [
        ("C-prefix (cancellation)", 1),
        ("numeric-only (normal)", 15),
        ("other-letter (non-sales)", 4),
    ]


def test_profile_of_edge_lines(spark, rows):
    lines = edge_lines(spark)
    missing = {r[0]: r[1] for r in rows(profile.null_profile(lines))}
    assert missing["UnitPrice"] == 2 and missing["Country"] == 1 and missing["InvoiceNo"] == 1
    assert rows(profile.duplicate_rows(lines)) == [(1,)]  # the NaN line equals the null line
    summary = rows(profile.negative_only_summary(lines))[0]
    assert summary == (1, 0, 1, False)
    assert rows(profile.negative_only_summary(lines.limit(0))) == [(0, 0, 0, True)]
