from __future__ import annotations

from ledgerloom.llm.tables import likely_among


def test_all_of_the_ids_and_few_others_stay(spark):
    rows = spark.range(0, 100_000).selectExpr("id - 50000 as id", "'x' as text")
    ids = rows.where("id % 37 = 0").select("id")
    kept = likely_among(rows, ids)
    assert kept.columns == ["id", "text"]
    assert kept.join(ids, "id").count() == ids.count()
    assert kept.count() < ids.count() + 500
    assert likely_among(rows, ids.limit(0)).count() == 0
    assert likely_among(rows.limit(0), ids).count() == 0
