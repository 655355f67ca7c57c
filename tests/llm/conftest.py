from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture
def documents(spark):
    """A documents table of texts, with a column more; (id, text) or plain texts."""
    def make(*texts, lang="en", source="s"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, lang, source, len(t or ""), "x") for i, t in rows], SCHEMA)
    return make


EDGES = (None, "", " \n\t", "one", "a b", "###", "a b", "x" * 50_000, "w " * 20_000)


@pytest.fixture
def edges():
    return EDGES
