"""Range-partitioned positions and followers against a sort in plain Python."""

import random

import pytest

from hushmark.plans import ranged


def brute(rows, keyed=True):
    """(key, order, tie) -> (position, next value) with nulls last and ties by the tie column."""
    last = lambda v: (v is None, v if v is not None else 0)
    ordered = sorted(rows, key=lambda r: ((last(r[0]) if keyed else 0), last(r[1]), r[2]))
    out, prev, pos = {}, object(), 0
    for i, r in enumerate(ordered):
        key = r[0] if keyed else None
        pos = pos + 1 if key == prev else 0
        prev = key
        nxt = ordered[i + 1] if i + 1 < len(ordered) else None
        out[r[2]] = (pos, nxt[3] if nxt is not None and ((nxt[0] if keyed else None) == key) else None)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    data, tie = [], 0
    # one conversation with 90 % null turns, one user with a single timestamp, many small groups, null keys
    for key, size, nulls, same in [("hot", 900, 0.9, False), ("flat", 300, 0.0, True), *[(f"c{i}", rng.randint(1, 6), 0.2, False) for i in range(80)], (None, 7, 0.3, False)]:
        for _ in range(size):
            order = None if rng.random() < nulls else (5 if same else rng.randint(0, 50))
            data.append((key, order, tie, f"v{tie}"))
            tie += 1
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("parts,batch", [(7, 3), (23, 10_000), (1, 5)])
def test_against_sort(spark, rows, parts, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame(rows, "k string, o long, t long, v string").repartition(5)
        # the tie column stands in for the row id, so that the brute force knows the order of ties
        got = ranged.ordered_rows(df, ["k"], ["o", "t"], ["v"], parts).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(rows)
    assert len(got) == len(rows)
    assert {r.t: (r.position, r.next_v) for r in got} == want


def test_whole_table(spark, rows):
    df = spark.createDataFrame(rows, "k string, o long, t long, v string")
    got = ranged.ordered_rows(df, [], ["o", "t"], ["v"], 9).collect()
    assert {r.t: (r.position, r.next_v) for r in got} == brute(rows, keyed=False)


def test_hot_group_is_split(spark, rows):
    df = spark.createDataFrame(rows * 20, "k string, o long, t long, v string")
    cut = ranged.ordered_rows(df, ["k"], ["o"], [], 16)
    sizes = [n for n in cut.rdd.glom().map(len).collect() if n]
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_empty(spark):
    df = spark.createDataFrame([], "k string, o long, t long, v string")
    assert ranged.ordered_rows(df, ["k"], ["o"], ["v"], 4).count() == 0
