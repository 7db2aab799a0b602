"""The entry points, in a session with nothing set."""

import __spark_entry__ as entry_point


def test_flagship(spark):
    df = entry_point.entry(spark)
    rows = {r["lang"]: r for r in df.collect()}
    assert set(rows) == {"de", "en", "es", "fr"}
    assert sum(r["total_removed"] for r in rows.values()) > 0


def test_names():
    names = entry_point.queries()
    assert set(entry_point.oracle_sql()) <= set(names)
    assert all(callable(q) for q in names.values())
