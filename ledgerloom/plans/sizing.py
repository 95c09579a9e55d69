"""Session settings that follow from the size of the input."""

from __future__ import annotations

MIB = 1024 * 1024

SPLIT = (128 * MIB, 2048 * MIB)  # Parquet read by a map task
MAP_TASKS = 50_000  # aimed at between those bounds
REDUCED = (64 * MIB, 1024 * MIB)  # Parquet behind a shuffle partition
SHUFFLE_PARTITIONS = 16_384  # aimed at between those bounds
MERGED_PARTITION = 256 * MIB


def _share(input_bytes: int, parts: int, bounds: tuple[int, int]) -> int:
    return min(max(-(-input_bytes // parts), bounds[0]), bounds[1])


def session_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings to build the session with; the jobs themselves change none.

    The full-row shuffle of the de-duplication decides. A transaction takes
    about 26 bytes in Parquet and 250 in Spark's row format, so a reducer's share
    of 64 MiB becomes a sort of about 0.6 GiB, and the largest, 1 GiB, a spilling
    sort of about 10 GiB, at any size of input. Map tasks times shuffle partitions
    is the number of shuffle blocks: 0.13 billion at 1 TiB, 0.8 billion at 10 TiB and
    5.2 billion at 100 TiB.

    Against the default codecs zstd halves the shuffled bytes for a quarter more
    time and takes a quarter off the tables at no measurable cost.
    """
    partitions = -(-input_bytes // _share(input_bytes, SHUFFLE_PARTITIONS, REDUCED))
    return {
        "spark.sql.files.maxPartitionBytes": str(_share(input_bytes, MAP_TASKS, SPLIT)),
        "spark.sql.shuffle.partitions": str(max(partitions, total_cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # What small partitions are merged to, and skewed ones are split into.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(MERGED_PARTITION),
        "spark.io.compression.codec": "zstd",
        "spark.sql.parquet.compression.codec": "zstd",
    }
