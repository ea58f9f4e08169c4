"""Every library query with SQL gives the same rows as DuckDB."""

from __future__ import annotations

import pytest
from .conftest import same_rows

from strandlake.plans import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, duck, sf_dir, name):
    same_rows(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLE_SQL[name])


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns[0] == "event_id"
    assert set(e.oracle_sql()) <= set(e.queries())


def test_library_does_not_import_the_corpus_operators():
    import re
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "strandlake"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"\bllm\b", p.read_text())
