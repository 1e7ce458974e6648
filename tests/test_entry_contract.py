"""Driver contract: entry() runs on sf0.001; every oracle belongs to a query."""

import os

import pytest

SMOKE = "/root/testdata/sf0.001"


def test_registry_shapes():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
    # The training-data queries are there if and only if their subpackage is.
    numbered = sorted(int(name[2:].split("_")[0]) for name in q if name.startswith("op"))
    assert numbered == (list(range(1, 14)) if E.HAS_LLM else [])
    assert ("pipeline" in q) == E.HAS_PIPELINE


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="smoke data not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["item_id", "title", "total_ratings", "avg_rating", "avg_rating_rounded"]
    avgs = [r.avg_rating for r in rows]
    assert avgs == sorted(avgs, reverse=True)
