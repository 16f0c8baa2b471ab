import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))


@pytest.fixture(scope="session")
def docs_of(spark: SparkSession):
    """A documents table of (doc_id, text) pairs, with the other columns filled in."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "src", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make
