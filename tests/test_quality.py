from __future__ import annotations

from conftest import plan_text

from ledgerloom.operators import dq_report, split_quality
from ledgerloom.schema import BRONZE_SCHEMA
from ledgerloom.sources import read_table, retail_view, write_parquet

NAN = float("nan")
# (id, quantity, age, price, expected part)
EDGES = [
    (1, 1, 20, 1.0, "valid"),
    (2, None, 20, 1.0, None),
    (3, None, 10, 1.0, "quarantine"),
    (4, 0, 20, 1.0, "quarantine"),
    (5, 1, 101, 1.0, "quarantine"),
    (6, 1, 100, 1.0, "valid"),
    (7, 1, 15, 1.0, "valid"),
    (8, 1, 14, 1.0, "quarantine"),
    (9, 1, 20, NAN, "valid"),
    (10, 1, None, 1.0, None),
    (11, 1, 20, None, None),
    (12, -1, None, None, "quarantine"),
    (13, 1, 20, -0.0, "quarantine"),
]


def edge_rows(transactions):
    return transactions(
        *[
            {"transaction_id": n, "quantity": q, "customer_age": a, "unit_price": p}
            for n, q, a, p, _ in EDGES
        ]
    )


def ids(df):
    return sorted(row.transaction_id for row in df.select("transaction_id").collect())


def test_split_follows_three_valued_logic(transactions):
    parts = split_quality(edge_rows(transactions))
    assert ids(parts.valid) == [n for n, *_, part in EDGES if part == "valid"]
    assert ids(parts.quarantine) == [n for n, *_, part in EDGES if part == "quarantine"]


def test_split_leaves_rows_as_they_are(transactions):
    rows = transactions({"gender": " male "}, {"gender": " male "}, {"quantity": 0, "gender": ""})
    parts = split_quality(rows)
    assert parts.valid.columns == rows.columns
    assert [row.gender for row in parts.valid.collect()] == [" male ", " male "]
    assert [row.gender for row in parts.quarantine.collect()] == [""]


def test_report_accounts_for_every_row(transactions):
    report = dq_report(edge_rows(transactions)).first().asDict()
    parts = [part for *_, part in EDGES]
    assert report == {
        "raw_rows": len(EDGES),
        "valid_rows": parts.count("valid"),
        "quarantine_rows": parts.count("quarantine"),
        "indeterminate_rows": parts.count(None),
        "quantity_not_positive": 2,
        "age_below_min": 2,
        "age_above_max": 1,
        "price_not_positive": 1,
    }


def test_report_of_nothing(transactions):
    assert set(dq_report(transactions().limit(0)).first()) == {0}


def test_known_counts(spark, small_dir):
    report = dq_report(retail_view(spark, small_dir)).first()
    assert tuple(report) == (6000, 5134, 632, 234, 88, 267, 165, 127)


def test_report_equals_the_parts(spark, small_dir):
    rows = retail_view(spark, small_dir)
    report = dq_report(rows).first()
    parts = split_quality(rows)
    assert (parts.valid.count(), parts.quarantine.count()) == (
        report.valid_rows,
        report.quarantine_rows,
    )
    total = report.valid_rows + report.quarantine_rows + report.indeterminate_rows
    assert total == report.raw_rows == rows.count()


def test_conditions_reach_the_scan(spark, transactions, tmp_path):
    path = str(tmp_path / "bronze")
    write_parquet(edge_rows(transactions), path)
    bronze = read_table(spark, path, BRONZE_SCHEMA)
    parts = split_quality(bronze)
    # Spark itself derives from the condition that rows with a NULL are lost to both parts.
    valid = plan_text(parts.valid)
    for pushed in ("IsNotNull(quantity)", "IsNotNull(customer_age)", "IsNotNull(unit_price)"):
        assert pushed in valid
    assert "PushedFilters: [Or(Or(" in plan_text(parts.quarantine)
    report = plan_text(dq_report(bronze))
    assert "ReadSchema: struct<customer_age:bigint,quantity:bigint,unit_price:double>" in report
