import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, lang, source)."""
    from creatorlens.llm.shipping import ship

    ship(spark)

    def make(rows, extra=""):
        full = [(r + ("en", "s1"))[:4] if len(r) == 2 else tuple(r)[:4] for r in rows]
        full = [(d, t, lang, source, len(t) if t is not None else None) for d, t, lang, source in full]
        table = spark.createDataFrame(full, DOCUMENTS)
        return table.selectExpr("*", extra) if extra else table

    return make


@pytest.fixture(scope="session")
def given(spark):
    from creatorlens.llm.shipping import ship

    ship(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
