"""The registered queries: each operator and job over the retail view of a data directory.

A query takes (spark, sf_dir) and returns a DataFrame. Queries named after a
job write their layers below a scratch folder first and read them back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import operators as ops
from ledgerloom.functions import is_bad_record, quality_rules
from ledgerloom.operators.sketches import DISTINCT_ERROR, RANK_ERROR
from ledgerloom.plans import (
    LayerPaths,
    apply_batch,
    bronze_to_silver,
    current_marts,
    current_quarantine,
    current_rollup,
    current_silver,
    follow_runs,
    raw_to_bronze,
    rebuild,
    run_pipeline,
)
from ledgerloom.schema import BRONZE_SCHEMA, GOLD_SCHEMAS, RAW_SCHEMA, SILVER_SCHEMA
from ledgerloom.sources import (
    Commit,
    Lake,
    exchanges,
    generator,
    land_run,
    read_quarantine_csv,
    read_accepted,
    read_raw,
    read_table,
    retail_view,
    scratch_path,
    transactions_for_ids,
    triage_files,
    write_bucketed,
    write_parquet,
    write_quarantine_csv,
)
from ledgerloom.sources.retail_view import TABLES
from ledgerloom.streaming import EventWindows, ingest_new_runs

GENERATOR_SEED = 7
GENERATOR_BAD_RATE = 0.05
GENERATOR_INGESTION_DATE = "2026-01-01"
LANDING_ROWS_PER_FILE = 5_000
UPSERT_BUCKETS = 16
CLUSTERED_FILES = 48
PROFILED_NUMBERS = ["transaction_id", "quantity", "unit_price"]
PROFILED = [*PROFILED_NUMBERS, "customer_id", "payment_type"]
PROFILE_RANKS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)
STATUSES = ["Delivered", "Cancelled", "Returned"]  # Fixed values: the view's order statuses.


def _fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_silver(ops.split_quality(retail_view(spark, sf_dir)).valid)


# --- scans and landing -------------------------------------------------------------------


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _fresh(spark, "raw-scan")
    land_run(retail_view(spark, sf_dir), raw, "run_1")
    return read_raw(spark, raw)


def explicit_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared schema rules: other case, wider type, a column no file has."""
    schema = "L_ORDERKEY bigint, l_linenumber bigint, l_returnflag string, l_channel string"
    return spark.read.schema(schema).parquet(f"{sf_dir}/lineitem.parquet")


def bronze_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail_view(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


def _drifting_runs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw rows as three runs whose files differ in their schema."""
    # The view's order statuses. The filters reach the order lines, so that each line is joined for one run only.
    rows = retail_view(spark, sf_dir)
    status = F.col("order_status")
    return {
        "run_delivered": rows.filter(status == "Delivered"),
        "run_cancelled": rows.filter(status == "Cancelled")
        .withColumn("quantity", F.col("quantity").cast("int"))
        .withColumn("channel", F.lit("web")),
        "run_returned": rows.filter(status == "Returned").drop("payment_type"),
    }


def bronze_multi_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LayerPaths.under(_fresh(spark, "multi-run"))
    for run_id, rows in _drifting_runs(spark, sf_dir).items():
        land_run(rows, paths.raw, run_id)
    raw_to_bronze(spark, paths.raw, paths.bronze)
    return read_table(spark, paths.bronze, BRONZE_SCHEMA)


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _fresh(spark, "incremental")
    paths = LayerPaths.under(root)
    *first, last = _drifting_runs(spark, sf_dir).items()
    for batch in (first, [last], []):
        for run_id, rows in batch:
            land_run(rows, paths.raw, run_id)
        ingest_new_runs(spark, paths.raw, paths.bronze, f"{root}/checkpoint")
    return read_table(spark, paths.bronze, BRONZE_SCHEMA)


def landing_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _fresh(spark, "chunks")
    land_run(retail_view(spark, sf_dir), raw, "run_1", rows_per_file=LANDING_ROWS_PER_FILE)
    per_file = (
        read_raw(spark, raw)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return per_file.agg(
        F.sum("rows").alias("row_count"),
        F.count_if(F.col("rows") > LANDING_ROWS_PER_FILE).alias("oversized_files"),
    )


def triaged_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of a landing zone that also holds prices as strings and files that aren't Parquet."""
    paths = LayerPaths.under(_fresh(spark, "triage"))
    for run_id, rows in _drifting_runs(spark, sf_dir).items():
        land_run(rows, paths.raw, run_id)
    spoilt = spark.read.schema(RAW_SCHEMA).parquet(f"{paths.raw}/run_delivered")
    land_run(spoilt.withColumn("unit_price", F.col("unit_price").cast("string")), paths.raw, "run_prices")
    spoilt.select("city").write.text(f"{paths.raw}/run_notes")
    raw_to_bronze(spark, paths.raw, paths.bronze, rejected=f"{paths.quarantine}/files")
    return read_table(spark, paths.bronze, BRONZE_SCHEMA)


def triage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each landed run that can be read, by kind, and why others can't."""
    raw = _fresh(spark, "triage-report")
    runs = _drifting_runs(spark, sf_dir)
    for run_id, rows in runs.items():
        land_run(rows, raw, run_id)
    spoilt = spark.read.schema(RAW_SCHEMA).parquet(f"{raw}/run_delivered")
    land_run(spoilt.withColumn("unit_price", F.col("unit_price").cast("string")), raw, "run_prices")
    spoilt.select("city").write.text(f"{raw}/run_notes")
    verdicts = triage_files(spark, raw)
    kinds = spark.createDataFrame(sorted({(v.run, v.kind, v.reason and v.reason.split("/")[-1].partition(".txt is ")[2].partition(".")[0] or v.reason) for v in verdicts}), "run string, kind string, reason string")
    run = F.element_at(F.split("_metadata.file_path", "/"), -2).alias("run")
    counted = read_accepted(spark, verdicts).select(run).groupBy("run").agg(F.count(F.lit(1)).alias("rows"))
    return kinds.join(counted, "run", "left").select("run", "kind", "reason", F.coalesce("rows", F.lit(0)).alias("rows"))


# --- quality -----------------------------------------------------------------------------


def quality_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [rule.alias(name) for name, rule in quality_rules().items()]
    return retail_view(spark, sf_dir).select(
        "transaction_id", *rules, is_bad_record().alias("is_bad")
    )


def quality_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.split_quality(retail_view(spark, sf_dir)).valid


def quality_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.split_quality(retail_view(spark, sf_dir)).quarantine


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dq_report(retail_view(spark, sf_dir))


def quarantine_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "quarantine")
    write_quarantine_csv(quality_quarantine(spark, sf_dir), path)
    return read_quarantine_csv(spark, path)


# --- silver ------------------------------------------------------------------------------


def gender_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.standardize_gender(retail_view(spark, sf_dir))


def dedup_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dedup_transactions(retail_view(spark, sf_dir))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


# --- what was valid at a time ------------------------------------------------------------


def _asof(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """To every transaction the price and discount that shipments of the same ``key`` had last, on or before its order date."""
    rows = _staged(spark, sf_dir, "transaction_id", "customer_id", key, "order_date", "ship_date", "unit_price", "discount_pct")
    rows = rows.withColumns({"order_day": F.col("order_date").cast("date"), "ship_day": F.col("ship_date").cast("date")})
    shipped = rows.select(key, "ship_day", F.col("unit_price").alias("valid_price"), F.col("discount_pct").alias("valid_discount"))
    asked = rows.select("transaction_id", "customer_id", key, "order_day")
    return ops.asof_join(asked, shipped, keys=[key], left_time="order_day", right_time="ship_day", values=["valid_price", "valid_discount"])


def asof_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, "product_id")


def asof_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few keys, each with a large share of all rows."""
    return _asof(spark, sf_dir, "product_category")


# --- gold --------------------------------------------------------------------------------


def order_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_total_amount(_silver(spark, sf_dir))


def daily_sales_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.daily_sales_metrics(_silver(spark, sf_dir))


def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.product_performance(_silver(spark, sf_dir))


def city_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.city_revenue(_silver(spark, sf_dir))


def mart_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = ops.mart_rollup(_silver(spark, sf_dir))
    return rollup.withColumn("cents", F.col("cents").cast("bigint"))


def city_revenue_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City revenue where some amounts are NaN and some beyond a bigint of cents."""
    place = F.when(F.col("transaction_id") % 500 == 3, F.col("state"))
    planted = {"AFRICA": float("nan"), "ASIA": 6e16}
    price, plain = F.col("unit_price"), F.lit(False)
    for state, value in planted.items():
        price, plain = F.when(place == state, F.lit(value)).otherwise(price), plain | (place == state)
    plain = F.coalesce(plain, F.lit(False))
    rows = _silver(spark, sf_dir).withColumns(
        {
            "unit_price": price,
            "quantity": F.when(plain, F.lit(1)).otherwise(F.col("quantity")),
            "discount_pct": F.when(plain, F.lit(0.0)).otherwise(F.col("discount_pct")),
        }
    )
    return ops.city_revenue(rows)


# --- whole jobs, through files -----------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str) -> tuple[LayerPaths, dict[str, int]]:
    paths = LayerPaths.under(_fresh(spark, "pipeline"))
    counts = run_pipeline(
        spark, paths, incoming=retail_view(spark, sf_dir), run_id="run_1"
    )
    return paths, counts


def pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts = _run(spark, sf_dir)
    return spark.createDataFrame([counts], ", ".join(f"{name} bigint" for name in counts))


def _silver_job(spark: SparkSession, sf_dir: str) -> LayerPaths:
    paths = LayerPaths.under(_fresh(spark, "silver-job"))
    write_parquet(retail_view(spark, sf_dir), paths.bronze)
    bronze_to_silver(
        spark, paths.bronze, paths.silver, paths.quarantine, quarantine_rows_per_file=2_000
    )
    return paths


def silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _silver_job(spark, sf_dir).silver, SILVER_SCHEMA)


def quarantine_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_quarantine_csv(spark, _silver_job(spark, sf_dir).quarantine)


def _pipeline_mart(mart: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths, _ = _run(spark, sf_dir)
        return read_table(spark, f"{paths.gold}/{mart}", GOLD_SCHEMAS[mart])

    return query


# --- batch by batch, and several outputs in one commit ------------------------------------


def _staged(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The raw rows, or columns of them, as a table, for queries that read them many times."""
    path = _fresh(spark, "staged")
    rows = retail_view(spark, sf_dir).select(*(columns or RAW_SCHEMA.fieldNames()))
    write_parquet(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def _followed(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake after two runs that a stream follows, a third that comes on its own and is delivered twice, and an empty one."""
    root = _fresh(spark, "followed")
    rows, lake = retail_view(spark, sf_dir), Lake(spark, f"{root}/lake")
    for status in ("Returned", "Delivered"):
        land_run(rows.filter(F.col("order_status") == status), f"{root}/raw", f"run_{status}")
        follow_runs(spark, f"{root}/raw", lake, f"{root}/checkpoint", buckets=UPSERT_BUCKETS)
    write_parquet(rows.filter(F.col("order_status") == "Cancelled"), f"{root}/late")
    late = read_table(spark, f"{root}/late", RAW_SCHEMA)
    for batch, batch_id in ((late, "late"), (late, "late"), (late.limit(0), "empty")):
        apply_batch(lake, batch, batch_id)
    return lake


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_silver(_followed(spark, sf_dir))


def incremental_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_quarantine(_followed(spark, sf_dir))


def incremental_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of all marts, merged from what each batch added and took back."""
    return current_rollup(_followed(spark, sf_dir)).withColumn("cents", F.col("cents").cast("bigint"))


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets rewritten and left alone by a large batch, by one of a single id, and by the first once more."""
    rows, lake = _staged(spark, sf_dir), Lake(spark, _fresh(spark, "upsert"))
    large = rows.filter("order_status <> 'Returned'")
    rest = ops.split_quality(rows.filter("order_status = 'Returned'")).valid
    least = rest.agg(F.min("transaction_id").alias("transaction_id"))
    found = []
    for name, batch in (("large", large), ("one id", rest.join(F.broadcast(least), "transaction_id", "left_semi")), ("large", large)):
        before = lake.current().parts.get("silver", {})
        apply_batch(lake, batch, name, buckets=UPSERT_BUCKETS)
        after = lake.current().parts["silver"]
        kept = sum(after.get(part) == directory for part, directory in before.items())
        found.append((len(found), name, len(after) - kept, kept, current_silver(lake).count()))
    return spark.createDataFrame(found, "step int, batch string, rewritten int, kept int, silver_rows bigint")


def versioned_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of three tables after a version, after a rebuild that broke off before its commit, and after one that went through."""
    rows, lake = _staged(spark, sf_dir), Lake(spark, _fresh(spark, "versions"))

    def break_off(commit: Commit) -> None:
        raise InterruptedError(commit.directory("silver"))

    seen = []

    def look(state: str) -> None:
        held = lake.current()
        counts = [F.count(F.lit(1)).alias("rows"), F.count_distinct("transaction_id").alias("ids")]
        for table, df in (("silver", current_silver(lake, held)), ("quarantine", current_quarantine(lake, held))):
            seen.append(df.agg(*counts).select(F.lit(state).alias("state"), F.lit(table).alias("table"), "rows", "ids"))
        city = current_marts(lake, held)["city_revenue"]
        seen.append(city.agg(F.count(F.lit(1)).alias("rows"), F.sum("order_count").alias("ids")).select(F.lit(state).alias("state"), F.lit("city_revenue").alias("table"), "rows", "ids"))

    rebuild(lake, rows.filter("order_status = 'Delivered'"), buckets=UPSERT_BUCKETS)
    look("first")
    try:
        rebuild(lake, rows, before_publish=break_off)
    except InterruptedError:
        look("broken off")
    rebuild(lake, rows)
    look("second")
    return reduce(DataFrame.unionByName, seen)


# --- layouts -----------------------------------------------------------------------------


def bucketed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with the number of raw rows of its id: both tables in buckets, de-duplicated, counted and joined in place."""
    name = f"ledgerloom_{uuid.uuid4().hex}"
    rows = _staged(spark, sf_dir)
    silver = write_bucketed(ops.clean_silver(ops.split_quality(rows).valid), f"{name}_silver", _fresh(spark, "bucketed"), buckets=UPSERT_BUCKETS)
    raw = write_bucketed(rows.select("transaction_id", "order_status"), f"{name}_raw", _fresh(spark, "bucketed"), buckets=UPSERT_BUCKETS)
    counts = raw.groupBy(F.col("transaction_id").alias("id")).agg(F.count(F.lit(1)).alias("raw_rows"))
    joined = ops.dedup_transactions(silver).hint("merge").join(counts.hint("merge"), F.col("transaction_id") == F.col("id"))
    return joined.select("transaction_id", "order_date", "city", "raw_rows").withColumn("exchanges", F.lit(exchanges(joined)))


def clustered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that a filter on two columns concerns, of a table clustered by three columns and of one that isn't."""
    rows = _staged(spark, sf_dir)
    columns = ["order_date", "city", "product_category"]
    found = []
    for layout, df in (("clustered", ops.clustered(rows, columns, CLUSTERED_FILES)), ("as it comes", ops.dealt_evenly(rows, CLUSTERED_FILES))):
        path = _fresh(spark, "layout")
        write_parquet(df, path)
        files = ops.files_by_extent(read_table(spark, path, RAW_SCHEMA), ["order_date", "city"])
        wanted = (F.col("high_order_date") >= "1996-01-01") & (F.col("low_order_date") < "1996-07-01") & (F.col("low_city") <= "NATION_7") & (F.col("high_city") >= "NATION_7")
        table = read_table(spark, path, RAW_SCHEMA)
        matching = table.where("order_date >= '1996-01-01' and order_date < '1996-07-01' and city = 'NATION_7'").agg(F.count(F.lit(1)).alias("matching_rows"))
        needed = files.agg(F.sum("rows").alias("rows"), (F.count_if(wanted) * 3 <= F.count(F.lit(1))).alias("third_of_files_at_most"))
        found.append(needed.join(F.broadcast(matching)).select(F.lit(layout).alias("layout"), "rows", "matching_rows", "third_of_files_at_most"))
    return reduce(DataFrame.unionByName, found)


# --- profiles ----------------------------------------------------------------------------


def _profiled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw rows, and the profiles of their runs (here, order statuses) and of all rows, merged from those."""
    rows = _staged(spark, sf_dir)
    path = _fresh(spark, "profiles")
    write_parquet(ops.column_profiles(rows, PROFILED, by="order_status"), path)
    runs = spark.read.parquet(path)
    return rows, runs.unionByName(ops.merge_profiles(runs).withColumn("run", F.lit("all")))


def _value_counts(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """``run, column, text, number, times``: how often each value of a column occurs in each run, and in all rows.

    A column is grouped by its values alone, with a count for each of the few runs beside each value: no task holds a value once for each
    column and run.
    """
    runs = sorted(r["run"] for r in profiles.where("run is not null and run <> 'all'").select("run").distinct().collect())

    def counted(name: str) -> DataFrame:
        times = [F.count_if(F.col("order_status") == run).alias(f"_n{k}") for k, run in enumerate(runs)]
        found = rows.groupBy(F.col(name).cast("string").alias("text")).agg(F.count(F.lit(1)).alias("_all"), *times)
        each = [F.struct(F.lit(run).alias("run"), F.col(n).alias("times")) for run, n in [("all", "_all"), *((run, f"_n{k}") for k, run in enumerate(runs))]]
        number = F.col("text").cast("double") if name in PROFILED_NUMBERS else F.lit(None).cast("double")
        return found.select(F.lit(name).alias("column"), "text", number.alias("number"), F.explode(F.array(*each)).alias("r")).select("r.run", "column", "text", "number", "r.times")

    return reduce(DataFrame.unionAll, [counted(name) for name in PROFILED]).where("times > 0")


def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each run and column, and whether distinct counts and quantiles are within the sketches' bounds of the exact ones."""
    rows, profiles = _profiled(spark, sf_dir)
    described = ops.describe_profiles(profiles, PROFILE_RANKS)
    # A row for each run and column: a few dozen.
    marked = _value_counts(rows, profiles).join(F.broadcast(described.select("run", "column", "quantiles")), ["run", "column"])
    known = F.when(F.col("number").isNotNull(), F.col("times"))
    n = F.nullif(F.sum(known), F.lit(0))
    fits = F.lit(True)
    for k, rank in enumerate(PROFILE_RANKS):
        mark = F.get("quantiles", F.lit(k))
        below, upto = (F.coalesce(F.sum(F.when(inside, known)), F.lit(0)) / n for inside in (F.col("number") < mark, F.col("number") <= mark))
        fits &= F.coalesce((below <= rank + RANK_ERROR) & (upto >= rank - RANK_ERROR), n.isNull())
    exact = marked.groupBy("run", "column").agg(F.count("text").alias("exact"), fits.alias("quantiles_fit"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.ceil(F.col("exact") * DISTINCT_ERROR)
    return described.join(exact, ["run", "column"]).select("run", "column", "rows", "known", near.alias("distinct_fits"), "quantiles_fit", F.col("quantiles").isNotNull().alias("has_quantiles"))


def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each run's columns differ from all rows; the distance is compared with the exact one."""
    rows, profiles = _profiled(spark, sf_dir)
    base = profiles.where("run = 'all'")
    drift = ops.profile_drift(profiles.where("run <> 'all'"), base).where("column = 'quantity' or column = 'payment_type'")
    # Exact distance for the column of few distinct values: cumulative shares at each of them.
    counts = rows.where("quantity is not null").groupBy("quantity").agg(*[F.count_if(F.col("order_status") == s).alias(s) for s in STATUSES])
    order = Window.orderBy("quantity")
    shares = {s: F.sum(s).over(order) / F.sum(s).over(Window.partitionBy()) for s in STATUSES}
    total = sum((F.col(s) for s in STATUSES[1:]), F.col(STATUSES[0]))
    every = counts.withColumn("_all", total).select(*[v.alias(s) for s, v in shares.items()], (F.sum("_all").over(order) / F.sum("_all").over(Window.partitionBy())).alias("_all"))
    exact = every.agg(*[F.max(F.abs(F.col(s) - F.col("_all"))).alias(s) for s in STATUSES])
    exact = exact.select(F.explode(F.create_map(*[x for s in STATUSES for x in (F.lit(s), F.col(s))])).alias("run", "exact"))
    near = F.abs(F.col("distance") - F.col("exact")) <= 2 / 100 + 2 * RANK_ERROR
    return drift.join(exact, "run").select("run", "column", F.round("null_share_change", 9).alias("null_share_change"), near.alias("distance_fits"))


# --- events ------------------------------------------------------------------------------


def _event_windows(spark: SparkSession, sf_dir: str) -> EventWindows:
    """Daily windows after three runs of ten days each, and a fourth with events of all days, some without a time."""
    root = _fresh(spark, "events")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    late = F.col("event_id") % 50 == 7
    events = events.withColumn("run", F.when(late, 3).otherwise(F.least(F.lit(2), F.floor((F.dayofmonth("ts") - 1) / 10))))
    events = events.withColumn("ts", F.when(F.col("event_id") % 500 != 57, F.col("ts")))
    cents = F.round(F.col("value") * 100).cast("bigint")
    windows = EventWindows(
        Lake(spark, f"{root}/lake"), f"{root}/raw", f"{root}/checkpoint",
        schema=events.drop("run").schema, time="ts", keys=["event_type"], sums={"cents": cents}, width="1 day", delay="2 days",
    )
    for run in range(4):
        land_run(events.where(F.col("run") == run).drop("run"), f"{root}/raw", f"run_{run}")
        windows.follow(spark)
    return windows


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    return _event_windows(spark, sf_dir).current().select(day, "event_type", "rows", "cents")


def event_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that landed, are in a window, came too late, or have no time."""
    return _event_windows(spark, sf_dir).report()


# --- generator ---------------------------------------------------------------------------


def _record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.schema(TABLES["lineitem"]).parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_id"))


def generated_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated transaction per order line, defects included."""
    return transactions_for_ids(
        _record_ids(spark, sf_dir),
        "record_id",
        seed=GENERATOR_SEED,
        ingestion_date=GENERATOR_INGESTION_DATE,
        bad_rate=GENERATOR_BAD_RATE,
    )


def generated_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that leave a column's domain: of the undamaged generator's none may, and every blanked one must."""
    ids = _record_ids(spark, sf_dir)
    blanked = F.col("record_id") % 997 == 0
    made = transactions_for_ids(
        ids.where(~blanked), "record_id", seed=GENERATOR_SEED, ingestion_date=GENERATOR_INGESTION_DATE
    )
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]
    return profile(made.unionByName(ids.where(blanked).select(*blank)))


def profile(rows: DataFrame) -> DataFrame:
    """How many rows there are, and in how many each column's value, or a missing one, is outside its domain."""

    def outside(name: str, low: float | str, high: float | str):
        return F.coalesce(~F.col(name).between(low, high), F.lit(True))

    def unlisted(name: str, values: list):
        known = [value for value in values if value is not None]
        bad = ~F.col(name).isin(known)
        return F.coalesce(bad, F.lit(None not in values))

    delay = F.datediff(F.col("ship_date").cast("date"), F.col("order_date").cast("date"))
    price_ok = F.lit(False)
    for category, (low, high) in generator.CATEGORY_PRICES.items():
        price_ok |= (F.col("product_category") == category) & F.col("unit_price").between(low, high)
    place_ok = F.lit(False)
    for city, state in generator.CITIES:
        place_ok |= (F.col("city") == city) & (F.col("state") == state)
    # Bounds and patterns of the generated columns.
    violations = {
        "transaction_id": outside("transaction_id", 1, 99_999_999),
        "order_date": outside("order_date", "2023-01-01", "2025-12-31"),
        "ship_date": ~delay.between(-3, 9),
        "customer_id": ~F.col("customer_id").rlike("^CUST[1-9][0-9]{0,5}$"),
        "customer_age": outside("customer_age", 10, 99),
        "gender": unlisted("gender", generator.GENDERS),
        "product_id": ~F.col("product_id").rlike("^PROD[1-9][0-9]{0,4}$"),
        "unit_price": ~price_ok,
        "quantity": outside("quantity", 1, 9),
        "discount_pct": outside("discount_pct", 0, 50),
        "place": ~place_ok,
        "payment_type": unlisted("payment_type", generator.PAYMENT_TYPES),
        "order_status": unlisted("order_status", generator.ORDER_STATUSES),
    }
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.coalesce(bad, F.lit(True))).alias(f"bad_{name}") for name, bad in violations.items()],
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_scan": raw_scan,
    "explicit_schema_scan": explicit_schema_scan,
    "bronze_count": bronze_count,
    "bronze_multi_run": bronze_multi_run,
    "bronze_incremental": bronze_incremental,
    "landing_chunks": landing_chunks,
    "triaged_bronze": triaged_bronze,
    "triage_report": triage_report,
    "asof_product": asof_product,
    "asof_category": asof_category,
    "quality_predicate": quality_predicate,
    "quality_valid": quality_valid,
    "quality_quarantine": quality_quarantine,
    "dq_report": dq_report,
    "quarantine_csv_roundtrip": quarantine_csv_roundtrip,
    "gender_standardized": gender_standardized,
    "dedup_transactions": dedup_transactions,
    "silver_clean": silver_clean,
    "order_amount": order_amount,
    "daily_sales_metrics": daily_sales_metrics,
    "product_performance": product_performance,
    "city_revenue": city_revenue,
    "mart_rollup": mart_rollup,
    "city_revenue_extremes": city_revenue_extremes,
    "silver_job": silver_job,
    "quarantine_job": quarantine_job,
    "pipeline_counts": pipeline_counts,
    "pipeline_daily_sales_metrics": _pipeline_mart("daily_sales_metrics"),
    "pipeline_product_performance": _pipeline_mart("product_performance"),
    "pipeline_city_revenue": _pipeline_mart("city_revenue"),
    "incremental_silver": incremental_silver,
    "incremental_quarantine": incremental_quarantine,
    "incremental_rollup": incremental_rollup,
    "upsert_buckets": upsert_buckets,
    "versioned_layers": versioned_layers,
    "bucketed_silver": bucketed_silver,
    "clustered_files": clustered_files,
    "profile_report": profile_report,
    "profile_drift": profile_drift,
    "event_windows": event_windows,
    "event_report": event_report,
    "generated_transactions": generated_transactions,
    "generated_profile": generated_profile,
}
