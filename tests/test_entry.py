from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import ROOT

from ledgerloom.queries import QUERIES


@pytest.mark.parametrize("missing", ["duckdb", "corpus_pipeline", "ledgerloom.llm", "public_tokenizers"])
def test_the_other_queries_are_there_without_what_the_optional_ones_import(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None; sys.path.insert(0, {str(ROOT)!r});"
        "import __spark_entry__ as driver; print(len(driver.queries()), len(driver.oracle_sql()))"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES))] * 2
