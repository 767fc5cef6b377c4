"""Each registered query against its SQL in DuckDB, as unordered rows."""

from __future__ import annotations

from collections import Counter

import pytest

from larkspan.plans import ORACLES, QUERIES


def cell(x):
    if isinstance(x, float):
        return round(x, 6) + 0.0
    return tuple(map(cell, x)) if isinstance(x, list | tuple) else x


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, duck):
    df = QUERIES[name](spark, data)
    got = rows_of(df.columns, df.collect())
    if name in ORACLES:
        expected = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(expected.columns)
        want = rows_of(expected.columns, expected.fetchall())
        assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
