"""Column profiles of runs as mergeable sketches, and drift between runs.

For each run and column a profile holds counts, a HyperLogLog sketch of the distinct values and a KLL sketch of the quantiles of
numbers. Profiles of several runs merge into that of all their rows, without reading a row again, and two runs are
compared by their profiles alone. Sketches are a few kilobytes each, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

LG_K = 12  # HyperLogLog: 4,096 registers, 1.6 % standard error
KLL_K = 400  # KLL: ranks within about 0.7 % with 99 % confidence
RANK_ERROR = 0.01
DISTINCT_ERROR = 0.065  # four standard errors


def column_profiles(df: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """``run, column, rows, known, distinct_sketch, quantile_sketch`` of each value of ``by`` (or of all rows, run NULL) and column.

    One scan with partial aggregation and one row for each task, run and column in the shuffle. NULL values aren't ``known`` and are in no
    sketch. Quantile sketches are of numbers only, as doubles, without NaN. Distinct values are told apart by their text.
    """
    run = F.lit(None).cast("string") if by is None else F.col(f"`{by}`").cast("string")
    measures = []
    for n, name in enumerate(columns):
        value = F.col(f"`{name}`")
        # No value of text NULL goes into a sketch; an empty group has none.
        measures += [F.count(value).alias(f"known_{n}"), F.hll_sketch_agg(value.cast("string"), F.lit(LG_K)).alias(f"distinct_{n}")]
        if isinstance(df.schema[name].dataType, NumericType):
            number = value.cast("double")
            measures.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(KLL_K)).alias(f"quantile_{n}"))
    grouped = df.groupBy(run.alias("run")).agg(F.count(F.lit(1)).alias("rows"), *measures)

    def profile(n: int, name: str) -> Column:
        quantile = F.col(f"quantile_{n}") if f"quantile_{n}" in grouped.columns else F.lit(None).cast("binary")
        return F.struct(F.lit(name).alias("column"), F.col(f"known_{n}").alias("known"), F.col(f"distinct_{n}").alias("distinct_sketch"), quantile.alias("quantile_sketch"))

    unpivoted = grouped.select("run", "rows", F.explode(F.array(*[profile(n, name) for n, name in enumerate(columns)])).alias("p"))
    return unpivoted.select("run", "p.column", "rows", "p.known", "p.distinct_sketch", "p.quantile_sketch")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """The profile of all runs together, run NULL."""
    merged = profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(KLL_K)).alias("quantile_sketch"),
    )
    return merged.select(F.lit(None).cast("string").alias("run"), *profiles.columns[1:])


def _quantiles(sketch: str, ranks: Column) -> Column:
    """NULL for a sketch of no numbers, which has none."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def describe_profiles(profiles: DataFrame, ranks: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """``run, column, rows, known, distinct_values, quantiles``; quantiles are NULL for what holds no numbers."""
    quantiles = _quantiles("quantile_sketch", F.array(*[F.lit(float(r)) for r in ranks]))
    return profiles.select("run", "column", "rows", "known", F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"), quantiles.alias("quantiles"))


def profile_drift(profiles: DataFrame, base: DataFrame, steps: int = 100) -> DataFrame:
    """How each run's columns differ from the profiles ``base`` (one for each column).

    ``run, column, null_share_change, distinct_ratio, distance``: ``distance`` is the greatest difference of the two
    distributions' ranks (Kolmogorov-Smirnov), from ``steps`` quantiles of either; NULL unless both hold numbers. It is
    within 2/steps and twice the sketches' rank error of the exact one.
    """
    marks = F.array(*[F.lit(k / steps) for k in range(steps + 1)])

    def share(known: str, rows: str) -> Column:
        return 1 - F.col(known) / F.nullif(F.col(rows), F.lit(0))

    def rank(quantiles: str, x: Column) -> Column:
        return F.size(F.filter(quantiles, lambda q: q <= x)) / (steps + 1)

    old = base.select("column", *[F.col(c).alias(f"base_{c}") for c in ("rows", "known", "distinct_sketch", "quantile_sketch")])
    both = profiles.join(old, "column")
    both = both.withColumns({f"_{name}": _quantiles(name, marks) for name in ("quantile_sketch", "base_quantile_sketch")})
    points = F.concat("_quantile_sketch", "_base_quantile_sketch")
    distance = F.array_max(F.transform(points, lambda x: F.abs(rank("_quantile_sketch", x) - rank("_base_quantile_sketch", x))))
    return both.select(
        "run",
        "column",
        (share("known", "rows") - share("base_known", "base_rows")).alias("null_share_change"),
        (F.hll_sketch_estimate("distinct_sketch") / F.nullif(F.hll_sketch_estimate("base_distinct_sketch"), F.lit(0))).alias("distinct_ratio"),
        distance.alias("distance"),
    )
