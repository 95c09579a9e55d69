from __future__ import annotations

import random

import pytest
from conftest import plan_text, sorted_rows

from ledgerloom.operators import (
    clean_silver,
    dedup_transactions,
    split_quality,
    standardize_gender,
)
from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources import retail_view

NAMES = RAW_SCHEMA.fieldNames()


def smallest_per_id(rows: list[tuple]) -> list[tuple]:
    """Brute force: NULL before any value, columns compared in order."""

    def rank(row):
        return [(value is not None, value if value is not None else 0) for value in row]

    best: dict = {}
    for row in rows:
        if row[0] not in best or rank(row) < rank(best[row[0]]):
            best[row[0]] = row
    return sorted(best.values(), key=repr)


def random_rows(count: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    return [
        {
            # A third of the rows share one id, another share has none.
            "transaction_id": rng.choice([7, 7, None, rng.randrange(count // 4), 8, 9]),
            "order_date": rng.choice([None, "2024-01-01", "2024-01-02"]),
            "gender": rng.choice([None, "", "F", "M"]),
            "quantity": rng.choice([None, 1, 2]),
            "unit_price": rng.choice([None, 1.5, 2.5]),
            "payment_type": rng.choice([None, "Card", "COD"]),
        }
        for _ in range(count)
    ]


def test_gender_is_rewritten_in_place(transactions):
    rows = transactions({"gender": " male "}, {"gender": None})
    out = standardize_gender(rows)
    assert out.columns == rows.columns
    assert sorted(row.gender for row in out.collect()) == ["M", "Unknown"]


def test_null_ids_are_one_transaction(transactions):
    ids = [None, None, 1, 1, 2]
    out = dedup_transactions(transactions(*[{"transaction_id": n} for n in ids]))
    assert sorted(map(repr, (row.transaction_id for row in out.collect()))) == ["1", "2", "None"]


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_dedup_equals_brute_force_for_any_partitioning(transactions, partitions):
    rows = transactions(*random_rows(2000, seed=partitions))
    expected = smallest_per_id([tuple(row) for row in rows.collect()])
    assert sorted_rows(dedup_transactions(rows.repartition(partitions))) == expected


def test_dedup_keeps_columns_and_handles_a_lone_key(spark, transactions):
    rows = transactions({})
    assert dedup_transactions(rows).schema == rows.schema
    lone = spark.createDataFrame([(1,), (1,), (None,)], "transaction_id bigint")
    assert sorted_rows(dedup_transactions(lone)) == [(1,), (None,)]


def test_one_row_per_id_is_kept_before_the_shuffle(spark, small_dir):
    plan = plan_text(clean_silver(retail_view(spark, small_dir)))
    physical = plan[plan.index("== Physical Plan ==") :]
    final = physical.index("row_number(), 1, Final")
    exchange = physical.index("Exchange hashpartitioning(transaction_id")
    partial = physical.index("row_number(), 1, Partial")
    assert final < exchange < partial
    assert "SinglePartition" not in physical


def shuffled_rows(df) -> list[int]:
    """Records written by each shuffle of a frame that was just run."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo.extend(children.apply(n) for n in range(children.size()))
    return found


def test_a_hot_id_reaches_its_reducer_as_one_row_per_task(transactions, tmp_path):
    tasks, hot, single = 4, 1000, 500
    path = str(tmp_path / "hot")
    rows = [{"transaction_id": 7, "quantity": n} for n in range(hot)]
    rows += [{"transaction_id": 1000 + n} for n in range(single)]
    transactions(*rows).repartition(tasks).write.parquet(path)
    df = dedup_transactions(transactions().sparkSession.read.parquet(path))
    assert len(df.collect()) == single + 1
    assert shuffled_rows(df) == [single + tasks]


def test_clean_silver_is_unique_and_taken_from_the_valid_rows(spark, small_dir):
    valid = split_quality(retail_view(spark, small_dir)).valid
    silver = clean_silver(valid)
    assert silver.columns == NAMES
    counts = {row.gender: row["count"] for row in silver.groupBy("gender").count().collect()}
    assert counts == {"F": 1506, "M": 1465, "Unknown": 1006}
    assert silver.select("transaction_id").distinct().count() == 3977
    assert silver.exceptAll(standardize_gender(valid)).count() == 0
