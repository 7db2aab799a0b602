"""Redaction: literal cases, a CPython model on generated texts, and plan shape."""

import random
import re

import pytest
from catalog.oracle import PATTERNS
from conftest import executed_plan
from pyspark.sql import functions as F

from hushmark.operators import redact
from hushmark.rules.pii import PII_RULES, TOKENS, PiiRule, name_pattern, select_rules

# The first five inputs are the ones that the task states.
CASES = [
    ("Hi, I'm John Smith, email me at john.smith@gmail.com",
     "Hi, I'm [NAME_REMOVED], email me at [EMAIL_REMOVED]", {"name": 1, "email": 1}),
    ("Call me at 555-123-4567 or (867) 555-0123",
     "Call me at [PHONE_REMOVED] or [PHONE_REMOVED]", {"phone": 2}),
    ("Follow me @username or Instagram: @myprofile",
     "Follow me [SOCIAL_REMOVED] or [SOCIAL_REMOVED]", {"social": 2}),
    ("Visit us at 123 Main Street, Suite 200", "Visit us at [ADDRESS_REMOVED]", {"address": 1}),
    ("Contact María García at +52 867 123 4567",
     "Contact [NAME_REMOVED] at [PHONE_REMOVED]", {"name": 1, "phone": 1}),
    ("see https://t.me/@bob and https://x.com/a?b=5551234567",
     "see [URL_REMOVED][SOCIAL_REMOVED] and [URL_REMOVED][PHONE_REMOVED]",
     {"phone": 1, "social": 1, "url": 2}),
    ("John Smith Brown White", "[NAME_REMOVED] [NAME_REMOVED]", {"name": 2}),
    ("tel: 555 1234", "[PHONE_REMOVED]", {"phone": 1}),
    ("Call me at: 555-4321", "Call me at: 555-4321", {}),
    ("MARÍA GARCÍA y Juan PÉREZ", "[NAME_REMOVED] y [NAME_REMOVED]", {"name": 2}),
    ("John\u00a0Smith", "[NAME_REMOVED]", {"name": 1}),
    ("John\x1cSmith", "[NAME_REMOVED]", {"name": 1}),
    ("éJohn Smith", "éJohn Smith", {}),
    ("Ana Sánchezé", "Ana Sánchezé", {}),
    ("white brown shoes", "[NAME_REMOVED] shoes", {"name": 1}),
    ("123 Main Street, by John Smith a@b.co. Next", "[ADDRESS_REMOVED]. Next",
     {"name": 1, "email": 1, "address": 1}),
    ("FB: Mary Johnson", "FB: [NAME_REMOVED]", {"name": 1}),
    ("ñjohn@x.com", "ñjohn[SOCIAL_REMOVED].com", {"social": 1}),
    ("Calle Principal 123, Col. Centro", "Calle Principal 123, Col. Centro", {}),
    ("Av. Universidad #456, CP 25000", "Av. Universidad #456, CP 25000", {}),
    ("+1 (743) 555-3824", "+1 [PHONE_REMOVED]", {"phone": 1}),
    ("12 Loma Col.Centro y mas. fin", "[ADDRESS_REMOVED]. fin", {"address": 1}),
    ("12 Loma Col. Centro", "12 Loma Col. Centro", {}),
    ("a@b.c|om x", "[EMAIL_REMOVED] x", {"email": 1}),
    ("Tel: hello", "[PHONE_REMOVED]hello", {"phone": 1}),
    ("call 555-123-4567\ufe0f now", "call [PHONE_REMOVED]\ufe0f now", {"phone": 1}),
    ("555-123-4567²", "555-123-4567²", {}),
    ("x https://only.url/here", "x [URL_REMOVED]", {"url": 1}),
]
CATEGORIES = [r.category for r in PII_RULES]


def model(text):
    """The rules as CPython's ``re`` runs them."""
    counts = {}
    for category, pattern in PATTERNS.items():
        compiled = re.compile(pattern, re.IGNORECASE)
        counts[category] = len(compiled.findall(text))
        text = compiled.sub(TOKENS[category], text)
    return text, counts


def run(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = redact.redact_messages(df, **options).collect()
    return [r for r in sorted(rows, key=lambda r: r["id"])]


def test_literal_cases(spark):
    rows = run(spark, [c[0] for c in CASES])
    for (text, expected, counts), row in zip(CASES, rows):
        assert row["text"] == expected, text
        found = {c: row[f"n_{c}"] for c in CATEGORIES if row[f"n_{c}"]}
        assert found == counts, text
        changed = text != expected
        total = sum(n for c, n in counts.items() if c != "url")
        assert row["_anonymized"] == (True if changed else None), text
        assert row["_pii_removed_count"] == (total if changed else None), text


def test_literal_cases_agree_with_cpython():
    for text, expected, counts in CASES:
        got, found = model(text)
        assert got == expected
        assert {c: n for c, n in found.items() if n} == counts


def generated_texts(n, seed):
    rng = random.Random(seed)
    pieces = [
        "John", "smith", "MARÍA", "García", "Ana", "Sánchez", "Johnson", "Juan", "éJohn", "ſmith",
        "a.b+c@ex-ample.co", "@", "@bob_9", "ñ@x.com", "x@y.z", "a@b.c|om", "..a@b.co", "me@site.org.",
        "555-123-4567", "(555)", "555.1234", "+52", "867", "123", "4567", "5551234567", "55512345678",
        "Tel:", "WhatsApp:", "cell:", "IG:", "Snapchat:", "fb:", "٣٤٥-123-4567",
        "12", "99999", "Main", "Street", "St.", "calle", "Col.", "Col.Centro", "Colonia", "Stone",
        "https://a.b/c?d=(e)", "HTTP://x[1]", "http://", "https://é.com/\u00a0z",
        " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x85", "\x1c", "\x1f", ".", ",", "-", "!", "?",
        "(", ")", ":", "/",
        "İ", "ı", "\u212a", "²", "½", "Ⅷ", "\u0301", "\ufe0f", "\u200d", "😊", "_", "的", "ß", "Å",
    ]
    texts = []
    for _ in range(n):
        parts = [rng.choice(pieces) for _ in range(rng.randint(1, 14))]
        glue = rng.choice(["", " ", " ", " "])
        texts.append(glue.join(parts))
    return texts


def test_generated_texts_agree_with_cpython(spark):
    texts = generated_texts(6000, seed=11)
    rows = run(spark, texts)
    for text, row in zip(texts, rows):
        expected, counts = model(text)
        assert row["text"] == expected, repr(text)
        assert {c: row[f"n_{c}"] for c in CATEGORIES} == counts, repr(text)


def test_empty_and_missing_text_stay_with_their_truth(spark):
    df = spark.createDataFrame(
        [(1, "", ("x",)), (2, None, ("y",)), (3, "hi", ("z",))],
        "id int, text string, _test_pii_added struct<names:string>",
    )
    rows = {r["id"]: r for r in redact.redact_messages(df).collect()}
    assert rows[1]["text"] == "" and rows[1]["_test_pii_added"]["names"] == "x"
    assert rows[2]["text"] is None and rows[2]["_test_pii_added"]["names"] == "y"
    assert rows[3]["_test_pii_added"] is None and rows[3]["_anonymized"] is None
    assert rows[2]["n_email"] == 0 and rows[2]["_pii_removed_count"] is None


def test_long_runs_stay_linear(spark):
    texts = [
        "5" + " " * 60_000 + "x", "Tel:" + " " * 60_000 + "¡", "a." * 300_000 + " @",
        "%20" * 200_000 + " @", "9" * 60_000, "7 " + "a " * 300_000,
    ]
    rows = run(spark, texts)
    assert [r["text"] for r in rows][2:] == texts[2:]


def test_dense_emails_agree_with_cpython(spark):
    rng = random.Random(2)
    alphabet = ["a", "B", "7", ".", "_", "%", "+", "-", "@", "@", "|", "ñ", " ", "co", ".co", "\u0301"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(4, 40))) for _ in range(20_000)]
    texts += ["a@b.co.x@y.zz", "x" * 70 + ".y" * 40 + "@z.org", "-" * 70 + "a" * 70 + "@b.co"]
    for text, row in zip(texts, run(spark, texts)):
        expected, counts = model(text)
        assert row["text"] == expected, repr(text)
        assert row["n_email"] == counts["email"], repr(text)


def test_selected_categories(spark):
    assert [r.category for r in select_rules(["phones", "emails", "names", "addresses"])] == [
        "name", "email", "phone", "address",
    ]
    with pytest.raises(ValueError, match="ids"):
        select_rules(["emails", "ids"])
    row = run(spark, ["John Smith j@x.com"], rules=select_rules(["email"]))[0]
    assert row["text"] == "John Smith [EMAIL_REMOVED]"


def test_own_rules_and_tokens(spark):
    own = (
        PiiRule("badge", r"B-\d+", "<$1\\>"),
        PiiRule("name", name_pattern(["Ada", "Lovelace"]), ""),
    )
    row = run(spark, ["Ada Lovelace has B-77"], rules=own)[0]
    assert row["text"] == "[REMOVED] has <$1\\>"
    assert row["n_badge"] == 1


def test_entities_longest_first(spark):
    df = spark.createDataFrame(
        [
            (1, "Ann Lee met Ann and Ann Lee", ["Ann", "Ann Lee", "Ann Lee"]),
            (2, "nobody", []),
            (3, "x", None),
            (4, "", ["Ann"]),
        ],
        "id int, text string, people array<string>",
    )
    rows = {r["id"]: r for r in redact.redact_messages(df, entities="people").collect()}
    token = TOKENS["name"]
    assert rows[1]["text"] == f"{token} met {token} and {token}"
    assert rows[1]["n_name"] == 3 and rows[1]["_pii_removed_count"] == 3
    assert rows[2]["text"] == "nobody" and rows[3]["n_name"] == 0
    assert rows[4]["n_name"] == 0 and rows[4]["_anonymized"] is None


def test_attached_mentions(spark):
    texts = spark.createDataFrame([("a", "Bo and Bo Li"), ("b", "none")], "id string, text string")
    found = spark.createDataFrame(
        [("a", "Bo"), ("a", "Bo"), ("a", "Bo Li"), ("a", None)], "id string, entity string"
    )
    joined = redact.attach_entities(texts, found, "id")
    done = redact.redact_messages(joined, entities="entities", mentions="n_mentions")
    rows = {r["id"]: r for r in done.collect()}
    assert rows["a"]["text"] == "[NAME_REMOVED] and [NAME_REMOVED]"
    assert rows["a"]["n_name"] == 3 and rows["b"]["n_name"] == 0


def test_fixed_list_of_names(spark):
    df = spark.createDataFrame([("Bo Li and Bo", ), ("bo",), (None,)], "text string")
    done = df.withColumn("found", redact.listed_entities("text", ["Bo", "Bo Li", "Cy"]))
    rows = redact.redact_entities(done, "found").collect()
    assert [r["text"] for r in rows] == ["[NAME_REMOVED] and [NAME_REMOVED]", "bo", None]
    assert [r["n_entities"] for r in rows] == [2, 0, 0]


def nested(spark):
    return spark.createDataFrame(
        [
            ("c1", [("1", "Hi John Smith", True, None), ("2", "", False, ("kept",))], "x"),
            ("c2", [("3", "go https://a.b 555-123-4567", None, ("gone",))], "y"),
            ("c3", None, "z"),
            ("c4", [], "w"),
        ],
        "conversation_id string, messages array<struct<message_id:string, text:string, "
        "has_emoji:boolean, _test_pii_added:struct<names:string>>>, other string",
    )


def test_nested_redaction_keeps_everything_else(spark):
    done = redact.redact_nested(nested(spark), counts=True)
    rows = {r["conversation_id"]: r for r in done.collect()}
    first, second = rows["c1"]["messages"]
    assert first["text"] == "Hi [NAME_REMOVED]" and first["_pii_removed_count"] == 1
    assert first["has_emoji"] is True and first["_anonymized"] is True
    assert second["text"] == "" and second["_anonymized"] is None
    assert second["_test_pii_added"]["names"] == "kept"
    (third,) = rows["c2"]["messages"]
    assert third["text"] == "go [URL_REMOVED] [PHONE_REMOVED]"
    assert third["_pii_removed_count"] == 1 and third["_test_pii_added"] is None
    assert rows["c3"]["messages"] is None and rows["c4"]["messages"] == []
    assert [rows[c]["other"] for c in ("c1", "c2", "c3", "c4")] == ["x", "y", "z", "w"]
    assert (rows["c2"]["n_phone"], rows["c2"]["n_url"], rows["c2"]["_pii_removed_count"]) == (1, 1, 1)
    assert rows["c3"]["n_name"] == 0


def test_nested_and_flat_agree(spark):
    texts = generated_texts(500, seed=5)
    flat = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    one = flat.select(F.struct("id", "text").alias("m")).groupBy(F.col("m.id") % 7).agg(
        F.collect_list("m").alias("messages")
    )
    got = {
        m["id"]: (m["text"], m["_pii_removed_count"])
        for r in redact.redact_nested(one).collect()
        for m in r["messages"]
    }
    want = {r["id"]: (r["text"], r["_pii_removed_count"]) for r in redact.redact_messages(flat).collect()}
    assert got == want


def test_statistics_add_up(spark):
    df = spark.createDataFrame(
        [("f1", t) for t, _, _ in CASES] + [("f2", "nothing")], "source string, text string"
    )
    redacted = redact.redact_messages(df)
    rows = {r["source"]: r.asDict() for r in redact.statistics(redacted, "source").collect()}
    for row in rows.values():
        parts = sum(v for k, v in row.items() if k.endswith("_removed") and k != "total_removed")
        assert row["total_removed"] == parts
    assert rows["f2"]["total_removed"] == 0 and rows["f1"]["total_removed"] > 20
    assert "url_removed" not in rows["f1"]


def test_observed_statistics_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([(t,) for t, _, _ in CASES], "text string")
    observed, seen = redact.observe_statistics(redact.redact_messages(df))
    observed.write.parquet(str(tmp_path / "out"))
    assert seen.get["messages"] == len(CASES)
    assert seen.get["phone_removed"] == sum(c.get("phone", 0) for _, _, c in CASES)


def test_redaction_is_idempotent_on_its_output(spark):
    texts = [c[1] for c in CASES if c[0] != c[1]]
    assert [r["text"] for r in run(spark, texts)] == texts


def test_plan_is_one_narrow_stage(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "id int, text string").write.parquet(str(tmp_path / "t"))
    plan = executed_plan(redact.redact_messages(spark.read.parquet(str(tmp_path / "t"))))
    assert "Exchange" not in plan and "Python" not in plan
    for rule in PII_RULES:
        token = rule.token.replace("[", "").replace("]", "")
        assert plan.count(f"[{token}]") == 1, rule.category


def test_statistics_shuffle_counts_and_not_text(spark, tmp_path):
    spark.createDataFrame([("a", "x")], "source string, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = executed_plan(redact.statistics(redact.redact_messages(df), "source"))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_own_rules_count(spark):
    rules = (PiiRule("idcard", r"\b[A-Z]{2}\d{6}\b", "[ID]"), PiiRule("site", "www", "[W]", counted=False))
    df = spark.createDataFrame([("AB123456 and www", "s"), ("none", "s")], "text string, source string")
    done = redact.redact_messages(df, rules=rules)
    row = done.orderBy("text").first()
    assert (row["text"], row["n_idcard"], row["_pii_removed_count"], row["_anonymized"]) == ("[ID] and [W]", 1, 1, True)
    (total,) = redact.statistics(done, "source", rules=rules).collect()
    assert total.asDict() == {"source": "s", "idcard_removed": 1, "total_removed": 1}
    nested_rows = df.selectExpr("array(struct(text)) as messages")
    (first, _) = redact.redact_nested(nested_rows, rules=rules, counts=True).orderBy("n_idcard", ascending=False).collect()
    assert (first["_pii_removed_count"], first["messages"][0]["_pii_removed_count"]) == (1, 1)


def test_entities_of_nested_messages(spark):
    message = "struct<text:string,people:array<string>>"
    rows = [([("Zoe Q met Zoe", ["Zoe", "Zoe Q"]), ("", ["Zoe"]), ("John Smith", None)],)]
    df = spark.createDataFrame(rows, f"messages array<{message}>")
    (done,) = redact.redact_nested(df, entities="people", counts=True).collect()
    assert [m["text"] for m in done["messages"]] == ["[NAME_REMOVED] met [NAME_REMOVED]", "", "[NAME_REMOVED]"]
    assert [m["_pii_removed_count"] for m in done["messages"]] == [2, None, 1]
    assert (done["n_name"], done["_pii_removed_count"]) == (3, 3)
    only = redact.redact_nested(df, rules=(), entities="people", counts=True).first()
    assert (only["n_name"], only["_pii_removed_count"]) == (2, 2)
    with pytest.raises(ValueError, match="nobody"):
        redact.redact_nested(df, entities="nobody")
