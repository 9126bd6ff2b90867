from __future__ import annotations

import duckdb
import pytest

NAMES = "id long"
TEXT = "the quick brown fox jumps over the lazy dog while rain falls on quiet hills and rivers run"


@pytest.fixture(scope="session")
def small(sf_dir):
    """{doc_id: text} of the smallest documents table."""
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY 1").fetchall())


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns named as the operators name theirs."""
    long_text = "\n".join(f"line {i} of a long text with it's own {i * 7} words" for i in range(3000))
    rows = [
        (1, TEXT), (1, TEXT), (2, TEXT), (None, TEXT), (3, None), (4, ""), (5, " \t\n "), (None, None), (6, long_text),
        (7, "one"), (8, TEXT + " again"), (9, "\n\n" + TEXT + "\n" + TEXT), (-5, "négatif 中文 ñandú!!"), (9, "other text"),
    ]
    rows = [(a, b, "en", None, 7, "x", 1.5, [1], a) for a, b in rows]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, id string, fp double, ids array<int>, row long"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
