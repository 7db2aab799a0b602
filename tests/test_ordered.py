"""Order-dependent plans against brute force, with groups cut into many chunks."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from hushmark.operators.messages import flatten, nest, nested_within_length, within_length
from hushmark.plans.jobs import run_record
from hushmark.sources.corpus import label_tasks
from hushmark.operators.transitions import first_transitions, invalid_transitions
from hushmark.plans import ordered
from hushmark.rules.labels import GUIDELINE_STAGE_EDGES, STAGE_EDGES

STATES = [*STAGE_EDGES, None, "ELSEWHERE"]


@pytest.fixture(scope="module")
def rows():
    """One conversation with half of all rows, some small ones, and gaps in the turns."""
    rng = random.Random(3)
    data = []
    for conversation, size in [("hot", 600), *[(f"c{i}", rng.randint(1, 9)) for i in range(60)], (None, 5)]:
        turns = sorted(rng.sample(range(size * 3), size))
        data += [(conversation, t, rng.choice(STATES), t * 40 + rng.randint(0, 90)) for t in turns]
    rng.shuffle(data)
    return data


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "conv string, turn long, stage string, seconds long").cache()


def groups(rows, by=1):
    kept = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[by], r[1]))
    return {k: list(v) for k, v in groupby(kept, key=lambda r: r[0])}


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_row_numbers(frame, rows, size):
    got = ordered.number_rows(
        frame.where("conv is not null"), ["conv"], ["turn"], ordered.chunk_by_position("turn", size)
    )
    want = {(c, r[1]): i for c, rs in groups(rows).items() for i, r in enumerate(rs)}
    assert {(r["conv"], r["turn"]): r["position"] for r in got.collect()} == want


def test_row_numbers_over_the_whole_table(frame, rows):
    keyed = frame.where("conv is not null").withColumn("h", F.md5(F.concat_ws("|", "conv", "turn")))
    got = ordered.number_rows(keyed, [], ["h"], ordered.chunk_by_hash(F.col("h"), 2)).collect()
    in_order = sorted(got, key=lambda r: r["h"])
    assert [r["position"] for r in in_order] == list(range(len(in_order)))


@pytest.mark.parametrize("size", [1, 10, 10_000, None])
@pytest.mark.parametrize("allow_self", [False, True])
@pytest.mark.parametrize("edges", [STAGE_EDGES, GUIDELINE_STAGE_EDGES])
def test_invalid_transitions(frame, rows, size, allow_self, edges):
    want = set()
    for conversation, rs in groups(rows).items():
        for i, (a, b) in enumerate(zip(rs, rs[1:])):
            fine = b[2] in edges.get(a[2], ()) or (allow_self and a[2] is not None and a[2] == b[2])
            if not fine:
                want.add((conversation, i, f"{a[2] or '<null>'} → {b[2] or '<null>'}"))
    chunk = None if size is None else ordered.chunk_by_position("turn", size)
    found = invalid_transitions(frame, "conv", "stage", ["turn"], chunk, edges, allow_self)
    assert {tuple(r) for r in found.collect()} == want
    assert [tuple(r) for r in first_transitions(found, "conv").collect()] == sorted(want)[:5]


def test_gated_edge(frame, rows):
    want = set()
    for conversation, rs in groups(rows, by=3).items():
        for i, (a, b) in enumerate(zip(rs, rs[1:])):
            fine = b[2] in GUIDELINE_STAGE_EDGES.get(a[2], ())
            if (a[2], b[2]) == ("CLOSING", "ICE_BREAKER"):
                fine = b[3] - a[3] >= 60
            if not fine:
                want.add((conversation, i, f"{a[2] or '<null>'} → {b[2] or '<null>'}"))
    found = invalid_transitions(
        frame, "conv", "stage", ["seconds", "turn"], F.floor(F.col("seconds") / 500),
        GUIDELINE_STAGE_EDGES,
        gap=((("CLOSING", "ICE_BREAKER"),), F.col("next_seconds") - F.col("seconds") >= 60),
    )
    assert {tuple(r) for r in found.collect()} == want


def test_stage_cases(spark):
    df = spark.createDataFrame(
        [("a", 0, "ICE_BREAKER"), ("a", 1, "ICE_BREAKER"), ("b", 0, "DEEP_EMOTION"), ("b", 1, "CLOSING")],
        "conv string, turn int, stage string",
    )
    chunk = ordered.chunk_by_position("turn")
    code = invalid_transitions(df, "conv", "stage", ["turn"], chunk)
    assert {(r["conv"], r["position"]) for r in code.collect()} == {("a", 0), ("b", 0)}
    guide = invalid_transitions(df, "conv", "stage", ["turn"], chunk, GUIDELINE_STAGE_EDGES)
    assert {r["conv"] for r in guide.collect()} == {"a"}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_missing_timestamps_come_last(spark, kind):
    df = spark.createDataFrame(
        [("a", None, 2), ("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-02 10:00:00", 0), ("a", None, 1)],
        "conv string, ts string, id int",
    ).withColumn("ts", F.col("ts").cast(kind))
    chunk = ordered.chunk_by_time(df, "ts", 3_600)
    numbered = ordered.number_rows(df, ["conv"], ["ts", "id"], chunk)
    got = [(r["ts"] is None, r["id"]) for r in sorted(numbered.collect(), key=lambda r: r["position"])]
    assert got == [(False, 1), (False, 0), (True, 1), (True, 2)]


@pytest.mark.parametrize("zone", ["UTC", "America/Mexico_City", "Asia/Beirut"])
def test_time_chunks_follow_local_time(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        hours = spark.range(0, 24 * 400).select(
            F.expr("timestamp_ntz'2021-01-01 00:30:00' + make_interval(0, 0, 0, 0, int(id))").alias("ts")
        )
        cut = hours.withColumn("chunk", ordered.chunk_by_time(hours, "ts", 3_600)).orderBy("ts")
        chunks = [r["chunk"] for r in cut.collect()]
        assert chunks == list(range(chunks[0], chunks[0] + len(chunks)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("span", [1, 100, 5000])
def test_trailing_count(frame, rows, span):
    kept = [r for r in rows if r[0] is not None]
    got = ordered.trailing_count(frame.where("conv is not null"), ["conv"], "seconds", span)
    want = sorted(
        (c, s, sum(1 for o in kept if o[0] == c and s - span <= o[3] <= s)) for c, _, _, s in kept
    )
    timeless = frame.where("conv is not null").limit(3).withColumn("seconds", F.lit(None).cast("bigint"))
    more = ordered.trailing_count(timeless, ["conv"], "seconds", span).collect()
    assert [r["recent"] for r in more] == [None] * 3
    assert sorted((r["conv"], r["seconds"], r["recent"]) for r in got.collect()) == want


def test_length_filter_keeps_whole_conversations(frame, rows):
    kept = within_length(frame, "conv", 3, 6)
    want = {(c, r[1]) for c, rs in groups(rows).items() if 3 <= len(rs) <= 6 for r in rs}
    assert {(r["conv"], r["turn"]) for r in kept.collect()} == want
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # counts, and no rows of a conversation in one place


def test_nest_splits_long_conversations(spark):
    flat = spark.createDataFrame(
        [("long", i, (f"m{i}",)) for i in range(25)] + [("short", 0, ("s",)), ("none", None, None)],
        "conv string, pos int, message struct<text:string>",
    )
    nested = nest(flat, ["conv"], part_size=10)
    rows = {(r["conv"], r["part"]): [m["text"] for m in r["messages"]] for r in nested.collect()}
    assert [len(rows[("long", p)]) for p in range(3)] == [10, 10, 5]
    assert sum((rows[("long", p)] for p in range(3)), []) == [f"m{i}" for i in range(25)]
    assert rows[("short", 0)] == ["s"] and rows[("none", 0)] == []
    again = flatten(nested.where("conv = 'none'")).collect()
    assert len(again) == 1 and again[0]["message"] is None
    numbers = {(r["conv"], r["part"]): (r["n_messages"], r["pos_offset"]) for r in nested.collect()}
    assert numbers[("long", 2)] == (25, 20) and numbers[("none", 0)] == (0, 0)


def test_a_conversation_of_any_length_is_one(spark):
    n = 10_010
    flat = spark.range(n).selectExpr(
        "'c' as conv", "id as pos", "struct(cast(id as string) as text) as message", "'f' as source_file"
    )
    nested = nest(flat, ["conv", "source_file"])
    assert nested.count() == 2
    assert nested_within_length(nested).count() == 0 and within_length(flat, "conv").count() == 0
    assert label_tasks(nested_within_length(nested)).count() == 0
    assert [r["meta"]["n_messages"] for r in label_tasks(nested).where("meta.part = 0").collect()] == [n]
    assert run_record(nested, "1").first()["conversations"] == 1
    rows = flatten(nested).select("pos", "message.text").collect()
    assert sorted(r["pos"] for r in rows) == list(range(n)) and all(str(r["pos"]) == r["text"] for r in rows)
    sparse = flat.withColumn("pos", F.col("pos") * 3)
    assert sorted(r["pos"] for r in flatten(nest(sparse, ["conv"])).collect()) == list(range(n))
