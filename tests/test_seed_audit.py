"""Seeding, recall with its known leaks, residual scans and structure checks."""

import re

import pytest
from pyspark.sql import functions as F

from hushmark.operators import audit, redact, seed
from hushmark.plans import derive
from hushmark.rules import pii, seeding


@pytest.fixture(scope="module")
def seeded(spark):
    """Every message of a made-up corpus is seeded, in both languages."""
    rows = [(i, "hola, gracias por todo" if i % 2 else "see you there", i % 5 == 0, None) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, text string, has_photo boolean, has_gif boolean")
    return seed.seed_messages(df, ["id"], percent=100).cache()


def test_media_and_empty_messages_are_left_alone(spark, seeded):
    assert all(r["seeded"] == (not r["has_photo"]) for r in seeded.collect())
    df = spark.createDataFrame([(1, ""), (2, None)], "id int, text string")
    assert not any(r["seeded"] for r in seed.seed_messages(df, ["id"], percent=100).collect())


def shape(form):
    """A form as a regular expression."""
    parts = re.findall(r"#+|\{word\}|[^#{]+", form)
    words = "(?:" + "|".join(seeding.WORDS) + ")"
    return "".join(rf"\d{{{len(p)}}}" if p[0] == "#" else words if p == "{word}" else re.escape(p) for p in parts)


def fits(slot, lang, value):
    if slot == "name":
        one, two = value.split(" ")
        return one in pii.NAME_BANK and two in pii.NAME_BANK
    forms = seeding.ADDRESS_FORMS[lang] if slot == "address" else seeding.FORMS[slot]
    return any(re.fullmatch(shape(f), value) for f in forms)


def test_truth_matches_text_and_template(seeded):
    sides, kinds = set(), set()
    for r in seeded.where("seeded").collect():
        base = "hola, gracias por todo" if r["id"] % 2 else "see you there"
        lang = r["seed_lang"]
        assert lang == ("es" if r["id"] % 2 else "en")
        chosen, parts = seeding.TEMPLATES[r["seed_template"]], []
        for slot, field in seeding.TRUTH_FIELDS.items():
            values = r["_test_pii_added"][field]
            assert len(values) == (slot in chosen)
            parts += [seeding.CARRIERS[lang][slot] + v for v in values]
            assert all(fits(slot, lang, v) for v in values)
        filled = seeding.JOIN.join(parts)
        assert r["text"] in (f"{filled}. {base}", f"{base} {filled}")
        sides.add(r["text"].startswith(base))
        kinds.add(chosen)
    assert sides == {True, False} and len(kinds) == len(seeding.TEMPLATES) == 20


def test_nested_seeding_is_in_place(spark):
    message = "message_id string, text string, has_photo boolean"
    rows = [([("a", "hello there", False)],), ([("b", "hola, gracias por", None), ("c", "no", True)],), ([],), (None,)] * 20
    df = spark.createDataFrame(rows, f"messages array<struct<{message.replace(' ', ':').replace(',:', ',')}>>")
    done = seed.seed_nested(df, percent=100)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    got = done.collect()
    assert [None if r.messages is None else [m.message_id for m in r.messages] for r in got] == [
        None if m is None else [x[0] for x in m] for (m,) in rows
    ]
    for r in got:
        for m in r.messages or []:
            assert (m._test_pii_added is None) == (m.message_id == "c")
            assert all(v in m.text for vs in m._test_pii_added or [] for v in vs)
    assert "_key" not in done.columns
    flat = spark.createDataFrame([("k", i, f"text {i}") for i in range(50)], "c string, i int, text string")
    nested = flat.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("i", "text"))).alias("messages"))
    one = {r.i: r.text for r in seed.seed_messages(flat, ["c", "i"]).collect()}
    two = {m.i: m.text for m in seed.seed_nested(nested, keys=["c"]).first().messages}
    assert one == two and any("text" != v[:4] or ";" in v for v in one.values())


def test_seeding_is_repeatable(spark):
    df = spark.createDataFrame([(i, "hello") for i in range(300)], "id int, text string")
    once = {tuple(r) for r in seed.seed_messages(df, ["id"]).select("id", "text").collect()}
    again = {
        tuple(r) for r in seed.seed_messages(df.repartition(5), ["id"]).select("id", "text").collect()
    }
    assert once == again
    hits = sum(text != "hello" for _, text in once)
    assert 45 <= hits <= 105  # a quarter


def test_recall_and_its_known_leaks(seeded):
    rows = audit.recall(seeded, "category", "value").collect()
    leaks = {(r["category"], r["value"]) for r in rows if r["recall"] < 1}
    # a seven-digit number; addresses that start with the street
    assert any(c == "phones" and re.fullmatch(r"\d{3}-\d{4}", v) for c, v in leaks)
    assert any(c == "addresses" and re.match("Calle|Avenida", v) for c, v in leaks)
    assert all(re.fullmatch(r"\d{3}-\d{4}", v) for c, v in leaks if c == "phones")
    assert all(re.match("Calle|Avenida", v) for c, v in leaks if c == "addresses")
    assert {c for c, _ in leaks} == {"phones", "addresses"}
    by_category = {r["category"]: r["recall"] for r in audit.recall(seeded, "category").collect()}
    assert by_category["names"] == by_category["emails"] == by_category["socials"] == 1.0
    assert by_category["addresses"] < 1.0


def test_no_residuals_by_the_scan_itself(seeded):
    before = audit.residual_summary(seeded).first()
    assert before["messages_with_pii"] > 200 and before["names"] > 0
    after = audit.residual_summary(redact.redact_messages(seeded)).first()
    assert after["messages_with_pii"] == 0
    assert audit.residual_details(redact.redact_messages(seeded), "id").count() == 0


def test_residual_scan_reads_the_raw_text(spark):
    df = spark.createDataFrame(
        [(1, "JUAN PÉREZ a@b.co IG: x 5551234567"), (2, None), (3, "clean")], "id int, text string"
    )
    rows = {r["id"]: r for r in audit.residuals(df).collect()}
    assert rows[1]["names"] == ["Juan Pérez"] and rows[1]["emails"] == ["a@b.co"]
    assert rows[1]["socials"] == ["@b", "IG: x"] and rows[1]["phones"] == ["5551234567"]
    assert rows[2]["names"] == [] and rows[2]["emails"] == []
    assert len(pii.AUDIT_NAMES) == 8


def test_seeding_totals_and_details(seeded):
    tagged = seeded.withColumn("file", F.when(F.col("id") < 100, "a").otherwise("b"))
    totals = {r["file"]: r for r in seed.seeding_totals(tagged, "file", conversation="id").collect()}
    assert (totals["a"]["messages"], totals["a"]["messages_seeded"]) == (100, 80)
    assert totals["b"]["percent_seeded"] == pytest.approx(80.0)
    details = seed.seeding_details(tagged, "file").collect()
    distinct = {(r["file"], r["category"]) for r in details}
    for (file, category) in distinct:
        n = sum(r["file"] == file and r["category"] == category for r in details)
        assert totals[file][f"distinct_{category}"] == n
    none = seed.seeding_totals(tagged.where("has_photo"), "file", conversation="id").first()
    assert none["messages_seeded"] == 0 and none["distinct_names"] == 0


def test_structure_checks(spark):
    a = spark.createDataFrame([("c", 0, "x", 1), ("c", 1, None, 2), ("d", 0, "z", 3)], "conv string, pos int, f string, g int")
    b = spark.createDataFrame([("c", 0, "x", 1), ("c", 1, "new", 2), ("e", 0, "z", 3)], "conv string, pos int, f string, g int")
    found = {tuple(r) for r in audit.structure_differences(a, b, ["conv", "pos"], ["f", "g"]).collect()}
    assert found == {("c", 1, "f"), ("d", 0, "missing_message"), ("e", 0, "extra_message")}
    counts = {tuple(r) for r in audit.structure_counts(a, b, "conv").collect()}
    assert counts == {("d", 1, 0), ("e", 0, 1)}
    changed = audit.rows_changed(a, b.union(b.where("g = 1")), ["conv", "g"]).collect()
    assert {tuple(r) for r in changed} == {("d", 3, "original", 1), ("e", 3, "redacted", 1), ("c", 1, "redacted", 1)}


def test_redaction_changes_text_only(spark, tiny):
    original = derive.messages(spark, tiny)
    done = redact.redact_messages(derive.seeded(spark, tiny))
    keys, fields = ["conv_id", "turn"], ["message_id", "role"]
    assert audit.structure_differences(original, done, keys, fields).count() == 0
    assert audit.rows_changed(original, done, keys + fields).count() == 0


def test_marked_lines(spark):
    df = spark.createDataFrame([(1, "a sk-1\nsk-YOUR_X_KEY\nnone\nask-me")], "id int, text string")
    got = [(r["line_no"], r["line"]) for r in audit.marked_lines(df, "id").collect()]
    assert got == [(0, "a sk-1"), (3, "ask-me")]


def test_filters_do_not_run_patterns_twice(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "id int, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = audit.residual_details(df, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == len(audit.SCANNED)
