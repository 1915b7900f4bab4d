from __future__ import annotations

import pytest

from tests import goldens
from tidemark.__main__ import main, run
from tidemark.plans import dashboard
from tidemark.sources import read_delimited, schemas


@pytest.fixture(scope="module")
def metrics_file(tmp_path_factory):
    lines = ["month,department,kpi_id,kpi_name,actual_value,target_value,unit"]
    for row in goldens.METRICS.strip().splitlines():
        department, name, target, values = row.split(";")
        lines += [f"2024-{i:02d},{department},{name},{name},{v},{target},%" for i, v in enumerate(values.split(), 1)]
    path = tmp_path_factory.mktemp("metrics") / "metrics.csv"
    path.write_text("\n".join(lines))
    return str(path)


def test_dashboard_job(spark, metrics_file, tmp_path):
    run(spark, "dashboard", metrics_file, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["alerts", "cards", "on_target", "status", "trend"]
    assert read_delimited(spark, f"{tmp_path}/alerts").count() == 68
    metrics = read_delimited(spark, metrics_file, schemas.KPI_METRICS)
    chosen = dashboard.results(metrics, ["Logistics"], "2024-02", "2024-05", 10.0, ["shipment_delay_days"])
    assert chosen["trend"].count() == 16 and chosen["cards"].count() == 4


def test_fraud_job_from_file(spark, tmp_path):
    lines = ["Time,V1,V4,V14,Amount,Class"] + [f"{i * 900},{i % 7 - 3},{i % 5 - 2},{i % 3 - 1},{i % 97 + i % 11},{int(i % 50 == 0)}" for i in range(200)]
    source = tmp_path / "cards.csv"
    source.write_text("\n".join(lines))
    run(spark, "fraud", str(source), str(tmp_path / "out"))
    summary = [r["value"] for r in spark.read.text(f"{tmp_path}/out/summary").collect()]
    assert summary[0] == "Total transactions: 200"
    flagged = read_delimited(spark, f"{tmp_path}/out/flagged_transactions", {"risk_score": "double"})
    assert f"Flagged: {flagged.count()} " in summary[1]


def test_ledger_job_needs_vendors(spark, tmp_path):
    with pytest.raises(SystemExit):
        run(spark, "ledger", "in.csv", str(tmp_path))
    source, vendors = tmp_path / "r.csv", tmp_path / "v.csv"
    source.write_text(
        "record_id,date,vendor_id,amount,currency,region,invoice_ref,payment_status,delivery_date,created_by\n"
        "R1,2024-01-01,V1,5,USD,N,I1,paid,2024-01-02,u\nR2,2024/01/01,V2,,XXX,N,I2,draft,2024-01-02,u\n"
    )
    vendors.write_text("vendor_id\nV1\n")
    run(spark, "ledger", str(source), str(tmp_path / "out"), str(vendors))
    report = read_delimited(spark, f"{tmp_path}/out/integrity_report", {"violations": "int"})
    assert {r["rule"].split(".")[0]: r["violations"] for r in report.collect()} == {
        "1": 1, "2": 0, "3": 1, "4": 0, "5": 1, "6": 0, "7": 1, "8": 1, "9": 1, "10": 1,
    }


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["nothing", "--input", "a", "--output", "b"])
