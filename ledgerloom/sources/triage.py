"""Which landed files can be read as raw transactions, found from their footers before any row is read.

A landing zone is as good as its worst file: one price that is a string, or a file that isn't Parquet, fails
the job that reads them all. Here such files are set apart, with the reason, and the others are read.

Spark reads the footers of a list of files in parallel tasks and merges their schemas. A list whose footers can't be read, don't merge
or don't fit the declared schema is halved until single files are left, so that a zone without bad files costs one job for each run,
and one with some of them a few more for each. The driver holds names and schemas, no rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType, StructType

from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources.files import children

_AT_ONCE = 8  # lists of files
_WIDENED = (ByteType, ShortType, IntegerType)


@dataclass(frozen=True)
class FileVerdict:
    """``kind`` is compatible, widening (32-bit integers among 64-bit columns) or rejected."""

    run: str
    file: str
    kind: str
    reason: str | None = None


def _fit(found: DataType, declared: DataType) -> str | None:
    if found == declared:
        return "compatible"
    return "widening" if isinstance(declared, LongType) and isinstance(found, _WIDENED) else None


def schema_kind(found: StructType, declared: StructType) -> tuple[str, str | None]:
    """Whether files with schema ``found`` can be read with ``declared``, and if not, why.

    Columns that the files lack and columns that they have in addition are no obstacle; names match in any case.
    """
    kinds = []
    for field in declared.fields:
        same = [f for f in found.fields if f.name.lower() == field.name.lower()]
        if len(same) > 1:
            return "rejected", f"columns {', '.join(f.name for f in same)} differ in case only"
        for f in same:
            kind = _fit(f.dataType, field.dataType)
            if kind is None:
                return "rejected", f"{field.name} is {f.dataType.simpleString()}, not {field.dataType.simpleString()}"
            kinds.append(kind)
    if not kinds:
        return "rejected", "none of the declared columns"
    return ("widening" if "widening" in kinds else "compatible"), None


def _reason(failure: Exception) -> str:
    if isinstance(failure, Py4JJavaError):
        cause = failure.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        return str(cause.getMessage() or cause.getClass().getName()).splitlines()[0][:300]
    condition = failure.getCondition() if isinstance(failure, PySparkException) else None
    return condition or str(failure).splitlines()[0][:300]


def _judge(spark: SparkSession, files: list[str], declared: StructType) -> tuple[str, str | None]:
    try:
        found = spark.read.option("mergeSchema", "true").parquet(*files).schema
        return schema_kind(found, declared)
    except Exception as failure:  # whatever a reader throws at a file that it can't read
        return "rejected", _reason(failure)


def _judge_all(spark: SparkSession, lists: list[list[str]], declared: StructType) -> dict[str, tuple[str, str | None]]:
    """Kind and reason of every file. Lists are judged several at a time, the halves of those that are rejected after them."""
    verdicts = {}
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        while lists:
            judge = inheritable_thread_target(spark)(partial(_judge, spark, declared=declared))
            halves = []
            for files, (kind, reason) in zip(lists, pool.map(judge, lists), strict=True):
                if kind == "rejected" and len(files) > 1:
                    half = len(files) // 2
                    halves += [files[:half], files[half:]]
                else:
                    verdicts |= dict.fromkeys(files, (kind, reason))
            lists = halves
    return verdicts


def triage_files(spark: SparkSession, raw_root: str, declared: StructType = RAW_SCHEMA, runs: list[str] | None = None) -> list[FileVerdict]:
    """A verdict on every file of the landing zone, or of the runs named.

    Hidden files, and those of a run that hasn't ended (it has no ``_SUCCESS``), are left out.
    """
    root = raw_root.rstrip("/")
    landed = {}
    for run in children(spark, root) if runs is None else sorted(runs):
        names = children(spark, f"{root}/{run}")
        files = [f"{root}/{run}/{name}" for name in names if not name.startswith(("_", "."))]
        if files and "_SUCCESS" in names:
            landed[run] = files
    verdicts = _judge_all(spark, list(landed.values()), declared)
    return [FileVerdict(run, file, *verdicts[file]) for run, files in landed.items() for file in files]


def read_accepted(spark: SparkSession, verdicts: list[FileVerdict], declared: StructType = RAW_SCHEMA) -> DataFrame:
    """The rows of all files that aren't rejected."""
    files = [v.file for v in verdicts if v.kind != "rejected"]
    return spark.read.schema(declared).parquet(*files) if files else spark.createDataFrame([], declared)


def rejected_files(spark: SparkSession, verdicts: list[FileVerdict]) -> DataFrame:
    """``run, file, reason`` of the files that can't be read."""
    rows = [(v.run, v.file, v.reason) for v in verdicts if v.kind == "rejected"]
    return spark.createDataFrame(rows, "run string, file string, reason string")
