import csv
import gzip
from pathlib import Path

import pytest
from fixtures import edge_lines
from pyspark.sql import functions as F

from ledgerlark.functions import half_even, plain_number, title_case
from ledgerlark.operators.clean import audit_seen, clean, clean_with_audit, cleaning_audit
from ledgerlark.plans.report import run_report
from ledgerlark.sources import (
    CSV_OPTIONS,
    append_lines,
    load_raw,
    load_with_quarantine,
    read_lines,
    read_set,
    read_text_rows,
    sales_lines,
    set_counts,
    write_csv,
    write_set,
)


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path / "missing.xyz"))
    (tmp_path / "lines.xyz").write_text("x")
    with pytest.raises(ValueError, match=r"\.xyz"):
        load_raw(spark, str(tmp_path / "lines.xyz"))


def test_csv_keeps_blanks_types_and_missing_values(spark, tmp_path, rows):
    path = str(tmp_path / "lines.CSV")
    write_csv(edge_lines(spark), path)
    again = load_raw(spark, path)
    assert again.schema == edge_lines(spark).schema
    assert again.exceptAll(edge_lines(spark)).count() == 0 and again.count() == edge_lines(spark).count()
    assert "PAPER CHAIN " in {r[0] for r in rows(again, "Description")}


def test_hand_written_csv(spark, tmp_path):
    file = tmp_path / "lines.csv"
    file.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '536365,85123A,"PAPER CRAFT , LITTLE BIRDIE",6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom\n'
        "C536379,D,Discount,-1,2010-12-01 09:41:00,27.5,,United Kingdom\n"
    )
    first, second = load_raw(spark, str(file)).orderBy(F.desc("Quantity")).collect()
    assert first.Description == "PAPER CRAFT , LITTLE BIRDIE" and first.CustomerID == 17850
    assert str(first.InvoiceDate) == "2010-12-01 08:26:00" and second.CustomerID is None


def test_csv_with_other_dates(spark, tmp_path):
    file = tmp_path / "lines.csv"
    file.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "1,2,MUG,6,12/1/2010 8:26,2.55,17850,France\n"
    )
    assert str(load_raw(spark, str(file), "M/d/yyyy H:mm").first().InvoiceDate) == "2010-12-01 08:26:00"


def test_numbers_have_no_exponent(spark):
    values = [10649572.444, 14646.0, 0.001, 123456789012.25, 3838.4386301369864, 0.00001]
    frame = spark.createDataFrame([(v,) for v in values], "v double").select("v", plain_number("v").alias("t"))
    for r in frame.collect():
        assert "E" not in r.t and float(r.t) == r.v


def test_half_even_and_title(spark):
    got = spark.sql("SELECT 0.125D a, 2.675D b, 24.865000000000002D c, \"o'neil kim-song 2nd\" t").select(
        half_even("a", 2), half_even("b", 2), half_even("c", 2), title_case("t")
    )
    assert tuple(got.first()) == (0.12, 2.68, 24.86, "O'Neil Kim-Song 2Nd")


def test_text_rows_and_lines_append(spark, tmp_path, rows):
    path = str(tmp_path / "people")
    write_csv(spark.createDataFrame([("Alice", 25), ("Bob", 30)], "name string, age int"), path)
    write_csv(spark.createDataFrame([("Kim", 40), ("Lee", 22)], "name string, age int"), path, mode="append")
    assert rows(read_text_rows(spark, path, ["name", "age"])) == [
        ("Alice", "25"), ("Bob", "30"), ("Kim", "40"), ("Lee", "22"),
    ]
    text = str(tmp_path / "notes")
    append_lines(spark.createDataFrame([("one",), ("two",)], "value string"), text)
    append_lines(spark.createDataFrame([("three",)], "value string"), text)
    assert rows(read_lines(spark, text)) == [("one",), ("three",), ("two",)]


def test_report_writes_all_tables(spark, tmp_path):
    source = str(tmp_path / "lines.csv")
    write_csv(sales_lines(spark, "/root/testdata/sf0.001"), source)
    run_report(spark, source, str(tmp_path / "out"))
    summaries = {p.name for p in (tmp_path / "out" / "summaries").iterdir()}
    assert summaries == {
        "q1_country_revenue.csv", "q2_monthly_revenue.csv", "q3_top_products.csv",
        "q4_large_order_impact.csv", "q5_top_customers.csv",
    }
    assert len(list((tmp_path / "out" / "charts").iterdir())) == 13
    (file,) = Path(tmp_path / "out" / "summaries" / "q5_top_customers.csv").glob("part-*.csv")
    with open(file, newline="") as handle:
        table = list(csv.DictReader(handle))
    assert len(table) == 20 and list(table[0]) == ["CustomerID", "TotalRevenue", "OrderCount", "AvgOrderValue"]
    assert table[0]["CustomerID"].endswith(".0")
    (months,) = Path(tmp_path / "out" / "summaries" / "q2_monthly_revenue.csv").glob("part-*.csv")
    names = [line.split(",")[0] for line in months.read_text().splitlines()]
    assert names[0] == "YearMonth" and names[1:] == sorted(names[1:]) and len(names) > 12
    spent = [float(r["TotalRevenue"]) for r in table]
    assert spent == sorted(spent, reverse=True)
    # The audit counted on the way is that of a query of its own, and its file is in order.
    audit = read_set(spark, str(tmp_path / "out" / "audit"), **CSV_OPTIONS)["cleaning_audit"]
    plain = cleaning_audit(sales_lines(spark, "/root/testdata/sf0.001"))
    assert [tuple(r) for r in audit.collect()] == [tuple(r) for r in plain.orderBy("Step").collect()]
    counts = set_counts(spark, str(tmp_path / "out" / "summaries"))
    assert counts["q5_top_customers"] == 20 and counts["q4_large_order_impact"] == 4


def test_audit_on_the_way(spark, rows):
    cleaned, seen = clean_with_audit(edge_lines(spark))
    kept = rows(cleaned)
    assert kept == rows(clean(edge_lines(spark))) and cleaned.columns == clean(edge_lines(spark)).columns
    assert rows(audit_seen(spark, seen)) == rows(cleaning_audit(edge_lines(spark)))


def test_a_set_is_seen_whole_or_not_at_all(spark, tmp_path, rows):
    folder = str(tmp_path / "set")
    one, two = spark.range(3), spark.createDataFrame([("x", 1.5), (None, None)], "t string, v double")
    with pytest.raises(FileNotFoundError):
        read_set(spark, folder)
    assert write_set({"one": one, "two": two}, folder, "parquet") == 1
    first = read_set(spark, folder)
    assert rows(first["one"]) == [(0,), (1,), (2,)] and first["two"].schema == two.schema
    # The second table fails: the first one's new files are there, but nobody sees them.
    broken = spark.range(2).select(F.raise_error(F.lit("no")).cast("string").alias("t"), F.lit(1.0).alias("v"))
    with pytest.raises(Exception, match="no"):
        write_set({"one": spark.range(50), "two": broken}, folder, "parquet")
    assert read_set(spark, folder)["one"].count() == 3 and set_counts(spark, folder) == {"one": 3, "two": 2}
    assert spark.read.parquet(f"{folder}/one.parquet").count() == 53
    # The next version is whole again, and what no version names is gone.
    assert write_set({"one": spark.range(7), "two": two.limit(0)}, folder, "parquet") == 2
    assert read_set(spark, folder)["one"].count() == 7 and read_set(spark, folder)["two"].count() == 0
    assert spark.read.parquet(f"{folder}/one.parquet").count() == 7


HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def test_other_formats_and_packed_files(spark, tmp_path):
    plain = HEADER + "1,2,MUG,6,2010-12-01 08:26:00,2.55,17850.0,France\n"
    with gzip.open(tmp_path / "lines.CSV.gz", "wt") as file:
        file.write(plain)
    packed = load_raw(spark, str(tmp_path / "lines.CSV.gz"))
    assert packed.first().Description == "MUG" and packed.first().CustomerID == 17850
    for kind in ("parquet", "orc", "json"):
        packed.withColumn("CustomerID", F.col("CustomerID").cast("double")).write.format(kind).save(str(tmp_path / kind))
        again = load_raw(spark, str(tmp_path / kind), file_format=kind)
        assert again.collect() == packed.collect() and again.schema == packed.schema
    packed.createOrReplaceTempView("packed_lines")
    assert load_raw(spark, "packed_lines", file_format="table").collect() == packed.collect()
    with pytest.raises(FileNotFoundError):
        load_raw(spark, "no_such_table", file_format="table")
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path / "nothing"), file_format="parquet")
    with pytest.raises(ValueError, match="xlsx"):
        load_raw(spark, str(tmp_path / "lines.CSV.gz"), file_format="xlsx")
    with pytest.raises(ValueError, match="parquet"):
        load_with_quarantine(spark, str(tmp_path / "parquet"), file_format="parquet")


def test_line_breaks_inside_quotes(spark, tmp_path):
    file = tmp_path / "lines.csv"
    file.write_text(HEADER + '1,2,"MUG\nOF ""TEA"", RED",6,2010-12-01 08:26:00,2.55,,France\n3,4,CUP,1,2010-12-02 08:26:00,1,,EIRE\n')
    got = [(r.InvoiceNo, r.Quantity, "\n" in r.Description) for r in load_raw(spark, str(file), multi_line=True).collect()]
    assert sorted(got) == [("1", 6, True), ("3", 1, False)]


def test_corrupt_lines_go_to_the_quarantine(spark, tmp_path):
    good = "1,2,MUG,6,2010-12-01 08:26:00,2.55,17850.0,France"
    bad = ["1,2,MUG,six,2010-12-01 08:26:00,2.55,,France", "1,2,MUG", "1,2,MUG,6,soon,2.55,,France", good + ",more"]
    file = tmp_path / "lines.csv"
    file.write_text(HEADER + "\n".join([good, *bad, good]) + "\n")
    lines, refused = load_with_quarantine(spark, str(file))
    assert [r.Quantity for r in lines.collect()] == [6, 6] and lines.schema == edge_lines(spark).schema
    assert sorted((r.record, r.reason) for r in refused.collect()) == sorted((b, "parsing error") for b in bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        load_raw(spark, str(file)).collect()
    with pytest.raises(FileNotFoundError):
        load_with_quarantine(spark, str(tmp_path / "missing.csv"))
