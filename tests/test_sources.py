"""Files in and out, whole jobs, streaming, and JSON profiles."""

import json

import pytest
from pyspark.sql import functions as F

from hushmark.config import JobConfig
from hushmark.operators import profile, review
from hushmark.plans import derive, jobs
from hushmark.sources import corpus
from hushmark.streaming import start_redaction


def conversation(i, **extra):
    return {
        "conversation_id": f"c{i}",
        "messages": [
            {"message_id": f"{i}-0", "text": "Soy María García, niño 😊", "timestamp": "t0",
             "author": "user", "has_emoji": True, "mood": "ok"},
            {"message_id": f"{i}-1", "text": "llama al 555-123-4567 o a@b.co", "author": "bot"},
            {"message_id": f"{i}-2", "text": "", "has_photo": True},
        ],
        **extra,
    }


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "raw"
    path.mkdir()
    many = [conversation(1, topic="x"), conversation(2), {"conversation_id": "empty"}]
    (path / "many.json").write_text(json.dumps(many, ensure_ascii=False), encoding="utf-8")
    (path / "one.json").write_text(json.dumps(conversation(3), indent=2, ensure_ascii=False), encoding="utf-8")
    (path / "notes.txt").write_text("not json")
    return path


def read_lines(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(str(path)).collect()]


def test_read_corpus(spark, folder):
    df = corpus.read_corpus(spark, str(folder))
    rows = {r["conversation_id"]: r for r in df.collect()}
    assert set(rows) == {"c1", "c2", "c3", "empty"}
    assert rows["c3"]["source_file"].endswith("one.json")
    assert rows["c1"]["topic"] == "x" and rows["c1"]["messages"][0]["mood"] == "ok"
    assert rows["empty"]["messages"] is None
    both = [str(folder / "many.json"), str(folder / "one.json")]
    assert corpus.read_corpus(spark, both, schema=corpus.CORPUS).count() == 4


def test_unexpected_shapes_are_errors(spark, tmp_path):
    (tmp_path / "odd.json").write_text('{"talks": []}')
    with pytest.raises(ValueError, match="messages"):
        corpus.read_corpus(spark, str(tmp_path))
    (tmp_path / "good.json").write_text(json.dumps(conversation(1)))
    found = corpus.files_without_messages(corpus.read_corpus(spark, str(tmp_path)))
    assert [r["source_file"].rsplit("/", 1)[1] for r in found.collect()] == ["odd.json"]
    (tmp_path / "broken.json").write_text('{"messages": [')
    with pytest.raises(Exception, match="(?i)malformed|parse|corrupt"):
        corpus.read_corpus(spark, str(tmp_path)).count()


def test_redact_corpus_job(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    summary = {
        r["source_file"].rsplit("/", 1)[1]: r for r in jobs.redact_corpus(spark, str(folder), out).collect()
    }
    assert summary["many.json"]["name_removed"] == 2 and summary["one.json"]["total_removed"] == 3
    lines = {c["conversation_id"]: c for c in read_lines(spark, f"{out}/conversations")}
    assert set(lines["c1"]) == {"conversation_id", "messages", "topic"}
    assert lines["empty"] == {"conversation_id": "empty"}
    first, second, third = lines["c3"]["messages"]
    assert first["text"] == "Soy [NAME_REMOVED], niño 😊" and first["mood"] == "ok"
    assert second["_pii_removed_count"] == 2 and second["_anonymized"] is True
    assert third == {"message_id": "3-2", "text": "", "has_photo": True}
    assert len(read_lines(spark, f"{out}/summary")) == 2
    (record,) = jobs.run_record(corpus.read_corpus(spark, str(folder)), "1.0").collect()
    assert (record["files_processed"], record["conversations"], record["status"]) == (2, 4, "completed")


def test_seeded_corpus_goes_on_to_redaction(spark, folder, tmp_path):
    many = [conversation(i, topic="t") for i in range(40)]
    (folder / "big.json").write_text(json.dumps(many, ensure_ascii=False), encoding="utf-8")
    out = str(tmp_path / "seeded")
    totals, details = jobs.seed_corpus(spark, str(folder), out)
    got = {r["source_file"].rsplit("/", 1)[1]: r for r in totals.collect()}
    assert (got["many.json"]["conversations"], got["many.json"]["messages"]) == (3, 6)
    assert (got["one.json"]["conversations"], got["one.json"]["messages"]) == (1, 3)
    assert got["big.json"]["messages"] == 120 and got["big.json"]["messages_seeded"] > 5
    lines = read_lines(spark, f"{out}/conversations")
    assert len(lines) == 44
    messages = [m for c in lines for m in c.get("messages", [])]
    assert len(messages) == 129 and {m.get("mood") for m in messages} == {"ok", None}
    seeded = [m for m in messages if "_test_pii_added" in m]
    assert len(seeded) == sum(r["messages_seeded"] for r in got.values())
    assert not any(m.get("has_photo") for m in seeded)
    for c in lines:
        ids = [m["message_id"] for m in c.get("messages", [])]
        assert ids == sorted(ids)
    summary = jobs.redact_corpus(
        spark, f"{out}/conversations", str(tmp_path / "clean"), multi_line=False
    ).collect()
    assert sum(r["email_removed"] for r in summary) > 43  # the corpus has one each, seeds add some
    clean = read_lines(spark, tmp_path / "clean" / "conversations")
    assert not any("_test_pii_added" in m for c in clean for m in c.get("messages", []))


def test_seeding_keeps_conversations_without_ids(spark, tmp_path):
    talks = [{"messages": [{"text": "one"}]}, {"messages": [{"text": "two"}, {"text": "three", "author": "x"}]}]
    (tmp_path / "a.json").write_text(json.dumps(talks))
    (tmp_path / "b.json").write_text(json.dumps({"messages": [{"text": "four"}]}))
    out = str(tmp_path / "out")
    totals, _ = jobs.seed_corpus(spark, str(tmp_path), out)
    got = {r["source_file"].rsplit("/", 1)[1]: (r["conversations"], r["messages"]) for r in totals.collect()}
    assert got == {"a.json": (2, 3), "b.json": (1, 1)}
    lines = read_lines(spark, f"{out}/conversations")
    assert sorted(len(c["messages"]) for c in lines) == [1, 1, 2]
    assert all(set(c) == {"messages"} for c in lines)
    assert {k for c in lines for m in c["messages"] for k in m} <= {"text", "author", "_test_pii_added"}
    (report,) = read_lines(spark, f"{out}/report")
    assert (report["files_processed"], report["conversations"], report["messages"]) == (2, 3, 4)


def test_badly_shaped_files_are_told(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "good.json").write_text(json.dumps([conversation(1), conversation(2)]))
    (source / "odd.json").write_text('{"talks": []}')
    (source / "broken.json").write_text('{"messages": [')
    for schema in (None, corpus.CORPUS):
        out = str(tmp_path / f"out{schema is None}")
        summary = jobs.redact_corpus(spark, str(source), out, on_bad="reject", schema=schema).collect()
        assert [r["source_file"].rsplit("/", 1)[1] for r in summary] == ["good.json"]
        assert summary[0]["output"] == f"{out}/conversations"
        rejected = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in read_lines(spark, f"{out}/rejected")}
        assert rejected == {"odd.json": "no messages", "broken.json": "malformed"}
        assert len(read_lines(spark, f"{out}/conversations")) == 2
    totals, _ = jobs.seed_corpus(spark, str(source), str(tmp_path / "s"), on_bad="reject")
    assert totals.count() == 1
    (source / "broken.json").unlink()
    with pytest.raises(ValueError, match="odd.json"):
        jobs.redact_corpus(spark, str(source), str(tmp_path / "f"))
    with pytest.raises(ValueError, match="on_bad"):
        jobs.redact_corpus(spark, str(source), str(tmp_path / "g"), on_bad="skip")


def test_label_tasks_keep_all_keys(spark):
    rows = spark.createDataFrame([([("t",)], "x", 1)], "messages array<struct<text:string>>, topic string, n int")
    (task,) = corpus.label_tasks(rows).collect()
    assert task["data"].asDict(True) == {"messages": [{"text": "t"}]} and task["meta"].asDict() == {"topic": "x", "n": 1}


def test_corpus_whose_arrays_are_all_empty(spark, tmp_path):
    (tmp_path / "e.json").write_text('[{"conversation_id": "a", "messages": []}]')
    summary = jobs.redact_corpus(spark, str(tmp_path / "e.json"), str(tmp_path / "out")).collect()
    assert [r["total_removed"] for r in summary] == [0]


def test_review_job(spark, tiny, tmp_path):
    flat = derive.annotations(spark, tiny)
    jobs.review_annotations(spark, flat, str(tmp_path / "r"))
    stats = {(r["section"], r["item"]): r["value"] for r in read_lines(spark, tmp_path / "r" / "stats")}
    rate = review.review_rate(review.review(flat)).first()
    assert stats[("summary", "messages_needing_review")] == rate["to_review"]
    corrections = read_lines(spark, tmp_path / "r" / "corrections")
    assert len(corrections) == rate["to_review"]
    assert corrections[0]["human_corrections"]["notes"] is None


def test_configured_job(spark, folder, tmp_path):
    config = JobConfig.from_dict(
        {
            "pipeline": {"version": "2.1", "name": "x"},
            "data_sources": {"raw_data_path": str(folder), "file_pattern": "*.json"},
            "anonymization": {"patterns_to_remove": ["emails", "phones"]},
            "pattern_analysis": {"vocabulary_size_limit": 4},
            "output": {"label_studio_format": True, "include_metadata": False},
        }
    )
    record = jobs.prepare_corpus(spark, config, str(tmp_path / "run")).first()
    assert (record["version"], record["conversations"], record["files_processed"]) == ("2.1", 3, 2)
    tasks = read_lines(spark, tmp_path / "run" / "tasks")
    texts = {m["text"] for t in tasks for m in t["data"]["messages"]}
    assert texts == {"Soy María García, niño 😊", "llama al [PHONE_REMOVED] o [EMAIL_REMOVED]", ""}
    assert all(set(t) == {"data"} for t in tasks)
    assert len(read_lines(spark, tmp_path / "run" / "vocabulary")) == 4
    with pytest.raises(ValueError, match="ids"):
        bad = JobConfig(str(folder), categories=("emails", "ids"))
        jobs.prepare_corpus(spark, bad, str(tmp_path / "bad"))


def test_config_file_defaults(tmp_path):
    (tmp_path / "c.json").write_text('{"data_sources": {"raw_data_path": "in/"}}')
    config = JobConfig.from_json(str(tmp_path / "c.json"))
    assert config == JobConfig("in/") and config.max_messages == 50


def test_label_tasks(spark, folder, tmp_path):
    corpus.write_label_tasks(corpus.read_corpus(spark, str(folder)), str(tmp_path / "tasks"))
    tasks = read_lines(spark, tmp_path / "tasks")
    assert len(tasks) == 4 and all(t["meta"]["source_file"] for t in tasks)
    bare = corpus.label_tasks(corpus.read_corpus(spark, str(folder)), with_metadata=False)
    assert bare.columns == ["data"]


def test_streamed_redaction_equals_batch(spark, tmp_path):
    texts = [("a", "I am John Smith"), ("b", "mail a@b.co"), ("c", None)]
    df = spark.createDataFrame(texts, "id string, text string")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = start_redaction(stream, out, "redact_test")
    assert query.awaitTermination(120)
    first = {r["id"]: r["text"] for r in spark.read.parquet(out).collect()}
    assert first == {"a": "I am [NAME_REMOVED]", "b": "mail [EMAIL_REMOVED]", "c": None}
    # started again, it goes on where it stopped
    spark.createDataFrame([("d", "@you")], df.schema).write.mode("append").parquet(source)
    assert start_redaction(stream, out, "redact_test").awaitTermination(120)
    assert spark.read.parquet(out).count() == 4


def test_json_profiles(spark):
    docs = [
        (1, '{"a": [{"x": 1, "y": 2}, 3], "b": "t", "c": {"z": null}}'),
        (2, '{"a": [], "b": 2.5, "c": null, "d": true}'),
        (3, '[{"k": 1}]'),
        (4, "7"),
        (5, "{broken"),
        (6, None),
    ]
    df = spark.createDataFrame(docs, "id int, j string")
    roots = {r["root_kind"]: r["n"] for r in profile.root_profile(df, "j").collect()}
    assert roots == {"object": 2, "array": 1, "int": 1, "invalid": 2}
    keys = {
        (r["key"], r["kind"], r["first_kind"]): (r["n"], r["min_length"], r["max_length"])
        for r in profile.key_profile(df, "j").collect()
    }
    assert keys[("a", "array", "object")] == (1, 2, 2)
    assert keys[("a", "array", None)] == (1, 0, 0)
    assert keys[("b", "string", None)][0] == 1 and keys[("b", "float", None)][0] == 1
    assert keys[("c", "null", None)][0] == 1 and keys[("d", "bool", None)][0] == 1
    assert keys[("$", "array", "object")] == (1, 1, 1) and keys[("$", "int", None)][0] == 1
    inner = {(r["key"], r["inner_key"]): r["n"] for r in profile.inner_key_profile(df, "j").collect()}
    assert inner == {("a", "x"): 1, ("a", "y"): 1, ("c", "z"): 1, ("$", "k"): 1}
    samples = profile.key_samples(df, "j", "id").where(F.col("key") == "b").collect()
    assert [(r["id"], r["value"]) for r in samples] == [(1, '"t"'), (2, "2.5")]
