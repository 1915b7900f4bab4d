from __future__ import annotations

import pytest

from tests.conftest import rows
from tidemark.operators import quality as q
from tidemark.plans import financials, ledger

SCHEMA = (
    "n int, record_id string, date string, vendor_id string, amount double, currency string, region string, "
    "invoice_ref string, payment_status string, delivery_date string, created_by string"
)


def record(n, **changes):
    base = {
        "n": n,
        "record_id": f"REC{n:05d}",
        "date": "2023-05-10",
        "vendor_id": "VND001",
        "amount": 100.0 + n,
        "currency": "USD",
        "region": "North",
        "invoice_ref": f"INV-{n}",
        "payment_status": "paid",
        "delivery_date": "2023-05-20",
        "created_by": "user_1",
    }
    return tuple({**base, **changes}.values())


@pytest.fixture(scope="module")
def records(spark):
    """100 records with the faults the rule set knows, several rules broken by one record included."""
    changes = {
        3: {"amount": None},
        4: {"vendor_id": None},
        5: {"currency": None},
        10: {"record_id": "REC00000"},
        11: {"record_id": "REC00000"},
        20: {"date": "2023/05/10"},
        21: {"date": "2023/05/10", "delivery_date": "2023-05-01"},
        30: {"delivery_date": "2023-05-09"},
        31: {"delivery_date": "2023-05-10"},
        40: {"amount": 0.0},
        41: {"amount": -9999.0},
        50: {"currency": "XYZ"},
        60: {"payment_status": "draft"},
        61: {"payment_status": None},
        70: {"vendor_id": "VND999"},
    }
    return spark.createDataFrame([record(n, **changes.get(n, {})) for n in range(100)], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def vendors(spark):
    return spark.createDataFrame([(f"VND{i:03d}",) for i in range(1, 51)], "vendor_id string")


@pytest.fixture(scope="module")
def report(records, vendors):
    return {r["rule"].split(".")[0]: r for r in ledger.report(records, vendors, ["n"]).collect()}


@pytest.mark.parametrize(
    "rule, violations, sample",
    [
        ("1", 3, "REC00003, REC00004, REC00005"),
        ("2", 3, "REC00000, REC00000, REC00000"),
        ("3", 2, "REC00020, REC00021"),
        ("4", 2, "REC00030, REC00031"),
        ("5", 3, "REC00003, REC00040, REC00041"),
        ("6", 1, "REC00041"),
        ("7", 2, "REC00005, REC00050"),
        ("8", 2, "REC00004, REC00070"),
        ("9", 2, "REC00060, REC00061"),
        ("10", 0, ""),
    ],
)
def test_rules(report, rule, violations, sample):
    row = report[rule]
    assert (row["violations"], row["sample_ids"]) == (violations, sample)
    assert row["status"] == ("FAIL" if violations else "PASS")


def test_severities_and_names(report):
    assert [report[str(i)]["severity"] for i in range(1, 11)] == [
        "Critical", "Critical", "Major", "Major", "Critical", "Minor", "Major", "Critical", "Major", "Minor",
    ]
    assert report["7"]["rule"] == "7. currency in {INR, USD, EUR, GBP}"


def test_samples_stop_after_ten(spark):
    df = spark.createDataFrame([(i, -1.0) for i in range(25)], "id int, amount double")
    rule = q.RowRule("positive", "Critical", q.not_positive("amount"))
    row = q.run_rules(df.repartition(5), [rule], "id").first()
    assert row["sample_ids"] == ", ".join(map(str, range(10))) + " …"
    hot = spark.createDataFrame([(i, "same") for i in range(25)] + [(99, "other")], "id int, k string")
    row = q.run_rules(hot.repartition(5), [q.UniqueRule("unique", "Major", ("k",))], "id").first()
    assert (row["violations"], row["sample_ids"]) == (25, ", ".join(map(str, range(10))) + " …")


def test_samples_of_repeated_keys_in_row_order(spark):
    df = spark.createDataFrame([(i, f"k{i % 13}") for i in range(39)] + [(100, "alone")], "id int, k string")
    row = q.run_rules(df.repartition(5), [q.UniqueRule("unique", "Major", ("k",))], "id").first()
    assert (row["violations"], row["sample_ids"]) == (39, ", ".join(map(str, range(10))) + " …")


def test_null_amounts(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,)], "a double")
    assert df.filter(q.not_positive("a")).count() == 1
    assert df.filter(q.not_positive("a", null_breaks=True)).count() == 2


def test_completeness_rule(spark):
    df = spark.createDataFrame([(i, None if i < 10 else 1) for i in range(100)], "id int, v int")
    row = q.run_rules(df, [q.CompletenessRule("complete", "Minor", 95.0)], "id").first()
    assert (row["status"], row["violations"], row["checked"]) == ("FAIL", 1, 2)


def test_score_and_counts(spark, records, vendors):
    table = ledger.report(records, vendors, ["n"])
    score = q.integrity_score(table).first()
    lost = (3 * (3 + 3 + 3 + 2) + 2 * (2 + 2 + 2 + 2) + 1 * 1) / 100
    assert score["score"] == pytest.approx((22 - lost) / 22 * 100) and score["grade"] == "A"
    assert tuple(q.status_counts(table).first()) == (1, 9)
    assert {r["severity"]: r["violations"] for r in q.severity_counts(table).collect()} == {"Critical": 11, "Major": 8, "Minor": 1}
    for value, grade in ((95.0, "A"), (80.0, "B"), (60.0, "C"), (10.0, "D")):
        one = spark.createDataFrame([("Major", int(1000 - value * 10), 1000)], "severity string, violations int, checked int")
        assert q.integrity_score(one).first()["grade"] == grade


def test_marked_rows(records, vendors):
    rules = [r for r in ledger.rules(records, vendors) if isinstance(r, q.RowRule)]
    marked = {r["n"]: len(r["broken_rules"]) for r in q.mark_rows(records, rules).collect()}
    assert marked[3] == 2 and marked[0] == 0 and marked[41] == 2
    assert q.violating_rows(records, rules).count() == 12


def test_job_tables(records, vendors):
    tables = ledger.results(records, vendors, ["n"])
    assert tables["integrity_report"].columns == ["rule", "severity", "status", "violations", "sample_ids"]
    assert tables["violations_by_rule"].count() == 10


RAW = (
    "` Segment` string, Country string, Product string, ` Units Sold ` string, `Sale Price` string, `Gross Sales` string, "
    "` Sales` string, COGS string, ` Profit ` string, Date string, `Month Number` int, Year int"
)


@pytest.fixture(scope="module")
def raw(spark):
    good = (" Government ", "France", "Paseo", "1,000.00", "$20.00", "$20,000.00 ", "$19,000.00", "$10,000.00", "$9,000.00", "1/13/2014", 1, 2014)
    data = [good, good]
    data += [(*good[:2], f"P{i}", *good[3:]) for i in range(30)]
    data.append(("Midmarket", "Spain", "Velo", " $-   ", "$7.00", "0", "$0.00", "$-5.00", " $-   ", "bad", 13, 2031))
    data.append(("Unknown", "Spain", "Velo", "10", "$7.00", "$100.00", "$65.00", "$0.00", "$900,000.00", "2/28/2014", 2, 2014))
    return spark.createDataFrame(data, RAW)


def test_financial_cleaning(raw):
    clean = financials.clean(raw)
    assert clean.count() == 33
    first = clean.filter("Product = 'P1'").first()
    assert (first["Segment"], first["Units Sold"], first["Gross Sales"]) == ("Government", 1000.0, 20000.0)
    assert first["Date"].isoformat() == "2014-01-13T00:00:00"


def test_financial_checks(raw):
    clean = financials.clean(raw)
    found = {(r["rule"], r["subject"]): (r["violations"], r["status"]) for r in financials.checks(clean, raw).collect()}
    assert found[(1, "Units Sold")] == (1, "FAIL")
    assert found[(1, "Country")] == (0, "PASS")
    assert found[(2, "row")] == (1, "INFO")
    assert found[(3, "Date")] == (1, "INFO")
    assert found[(4, "Units Sold")] == (0, "PASS")
    assert found[(6, "Sales")] == (1, "FAIL")
    assert found[(7, "Profit")] == (1, "INFO")
    assert found[(8, "Gross Sales")] == (1, "INFO")
    assert found[(9, "COGS")] == (2, "FAIL")
    assert found[(10, "Segment")] == (0, "PASS")


def test_gross_zero_against_a_computed_amount_counts(spark, raw):
    clean = financials.clean(raw)
    odd = clean.withColumn("Gross Sales", financials.F.lit(0.0))
    assert financials.validated(odd).filter("gross_diff_pct > 0.10").count() == 32


def test_issue_report(raw):
    lines = [r["line"] for r in financials.issue_report(financials.checks(financials.clean(raw))).orderBy("line_no").collect()]
    assert lines[0] == "FINANCIAL DATA VALIDATION REPORT"
    assert "  • Rule 1: 1 nulls in Units Sold" in lines
    assert "  • Rule 9: 2 rows with COGS <= 0" in lines
    assert lines[3] == f"ISSUES FOUND: {len(lines) - 4}"


def test_issue_report_of_a_clean_table(raw):
    good = financials.clean(raw).filter("Product like 'P%'")
    lines = rows(financials.issue_report(financials.checks(good)), "line_no")
    assert lines[-1] == (3, "✓ ALL VALIDATION RULES PASSED") and len(lines) == 4


def test_financial_job(raw):
    tables = financials.results(raw)
    assert tables["validated_financials"].count() == 33
    assert rows(tables["unexpected_segments"]) == [("Segment", "Unknown", 1)]
    assert rows(tables["out_of_range"]) == [("Month Number", 1), ("Year", 1)]
    failures = {r["column"]: r["failures"] for r in tables["amount_failures"].collect()}
    assert failures["Units Sold"] == 1 and failures["COGS"] == 0
    assert tables["overview"].first()["segments"] == 3


def keyed_rules():
    return [
        q.RowRule("positive", "Critical", q.not_positive("v")),
        q.UniqueRule("one column", "Critical", ("k",)),
        q.UniqueRule("two columns", "Major", ("k", "v")),
    ]


def test_rules_of_keys_equal_counting(spark):
    """Every rule against plain Python: NULL keys, both zeros, a hot key, a reference of another type with a NULL in it."""
    data = [(i, None if i % 11 == 0 else 0.0 if i % 5 < 3 else i % 37 - 0.0, None if i % 29 == 0 else i % 7 - 3) for i in range(400)]
    data += [(400, -0.0, 1), (401, 1e9, 2)]
    df = spark.createDataFrame(data, "id int, k double, v int").repartition(7)
    reference = spark.createDataFrame([(0,), (3,), (None,)], "known bigint")
    rules = [*keyed_rules(), q.ReferenceRule("known", "Major", "k", reference, "known"), q.CompletenessRule("complete", "Minor", 95.0)]
    found = {r["rule"]: r for r in q.run_rules(df, rules, "id").collect()}
    ks, kvs = [k for _, k, _ in data], [(k, v) for _, k, v in data]
    broken = {
        "positive": [i for i, _, v in data if v is not None and v <= 0],
        "one column": [i for i, k, _ in data if ks.count(k) > 1],
        "two columns": [i for i, k, v in data if kvs.count((k, v)) > 1],
        "known": [i for i, k, _ in data if k not in (0.0, 3.0)],
    }
    for rule, ids in broken.items():
        row = found[rule]
        assert (row["violations"], row["checked"]) == (len(ids), len(data)), rule
        assert row["sample_ids"] == ", ".join(map(str, ids[:10])) + (" …" if len(ids) > 10 else ""), rule
    assert (found["complete"]["violations"], found["complete"]["checked"]) == (1, 3)


def test_rules_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, k double, v int")
    rules = [*keyed_rules(), q.CompletenessRule("complete", "Minor", 95.0)]
    found = [(r["violations"], r["checked"], r["status"], r["sample_ids"]) for r in q.run_rules(df, rules, "id").collect()]
    assert found == [(0, 0, "PASS", "")] * 3 + [(0, 3, "PASS", "")]


def test_samples_read_the_table_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 40 as k", "id - 3 as v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = q.run_rules(df, keyed_rules(), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") == 1
