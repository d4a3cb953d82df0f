from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names operators use inside."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None, 1, 2, None) for r in rows]
        return spark.createDataFrame(full, DOCS + ", sha long, name long, kept string")

    return build


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
