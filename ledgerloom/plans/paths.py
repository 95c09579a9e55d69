"""Guard against overwriting what a job reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerloom.sources.files import qualified


def check_disjoint(spark: SparkSession, inputs: list[str], outputs: list[str]) -> None:
    """Fails when an output equals, contains or lies within another path.

    An overwrite deletes its target before the input is read, so a job that
    writes where it reads fails halfway and leaves neither.
    """
    names = {path: qualified(spark, path).split("/") for path in inputs + outputs}
    for position, output in enumerate(outputs):
        for other in inputs + outputs[:position]:
            ours, theirs = names[output], names[other]
            shared = min(len(ours), len(theirs))
            if ours[:shared] == theirs[:shared]:
                raise ValueError(f"output {output!r} overlaps {other!r}")
