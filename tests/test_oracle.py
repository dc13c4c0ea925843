"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect
from conftest import SF

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, connect(SF), ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert "total_line_items" in out.columns


def test_every_section_is_registered():
    counts = {"s": 11, "c": 7, "k": 3, "e": 12, "j": 16, "f": 18, "n": 13, "a": 16, "q": 18, "r": 11, "v": 6, "m": 6, "h": 12, "t": 8, "x": 4}
    for letter, n in counts.items():
        for i in range(1, n + 1):
            assert any(k.startswith(f"{letter}{i}") and not k[len(f"{letter}{i}")].isdigit() for k in QUERIES), f"{letter}{i}"
