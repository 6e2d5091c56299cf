"""Queries of this part beside their SQL, over whole tables."""

from __future__ import annotations

import pytest

from courtside.llm.queries import ORACLE, QUERIES
from tests.compare import sql_rows, table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(*sql_rows(ORACLE[name], SF))


def test_nothing_else_in_the_library_imports_this_part():
    from pathlib import Path

    import courtside

    root = Path(courtside.__file__).parent
    for file in root.rglob("*.py"):
        if "llm" not in file.relative_to(root).parts:
            assert "llm" not in file.read_text(), file
