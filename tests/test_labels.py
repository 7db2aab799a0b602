"""Labels, agreement, review and gates on small hand-made tables."""

import hashlib
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hushmark.functions import bar, percent
from hushmark.operators import agreement, gates, guidelines, labels, review
from hushmark.plans import reports
from hushmark.rules import labels as rules


def pairs_of(rows):
    return {tuple(r) for r in rows}


# --- labels ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(
        [
            ("1", "a", "NEGATIVE_FEEDBACK", "DEEP_EMOTION", "LEVEL_1_FLIRT_SAFE", "PROFILE_1_DIRECTO"),
            ("2", "a", "TRANSACTIONAL_INQUIRY", "DEEP_EMOTION", "LEVEL_3_INAPPROPRIATE", "PROFILE_1_DIRECTO"),
            ("3", "b", None, "HIGH_INTENT", "LEVEL_3_INAPPROPRIATE", "PROFILE_2_HESITANTE"),
            ("4", "b", "OTHER", None, None, "PROFILE_3_DECEPCIONADO"),
        ],
        "message_id string, conversation_id string, primary_intent string, rapport_stage string, "
        "safety_level string, profile_id string",
    )


def test_distribution_bases(labelled):
    own = {(r["dimension"], r["label"]): r["share"] for r in labels.distribution(labelled).collect()}
    assert own[("primary_intent", "OTHER")] == pytest.approx(1 / 3)
    assert own[("safety_level", "LEVEL_3_INAPPROPRIATE")] == pytest.approx(2 / 3)
    assert not any(d == "customer_status" for d, _ in own)  # column is not there
    whole = labels.distribution(labelled, ["primary_intent"], all_records=True).collect()
    assert {r["label"]: r["share"] for r in whole}["OTHER"] == 0.25
    first = labels.sorted_distribution(labels.distribution(labelled)).collect()
    assert [r["dimension"] for r in first] == sorted(r["dimension"] for r in first)


def test_domain_violations(labelled):
    found = labels.domain_violations(labelled, "message_id").collect()
    assert pairs_of(found) == {("4", "primary_intent", "OTHER")}


def test_conflicts(labelled):
    found = pairs_of(labels.conflicts(labelled, "message_id").collect())
    assert found == {
        ("1", "negative_feedback_low_safety"),
        ("2", "transactional_in_deep_emotion"),
        ("2", "inappropriate_with_high_rapport"),
        ("3", "inappropriate_with_high_rapport"),
    }
    counts = {r["rule"]: r["n"] for r in labels.conflict_counts(labelled).collect()}
    assert counts["inappropriate_with_high_rapport"] == 2
    partial = labels.conflicts(labelled.drop("rapport_stage"), "message_id").collect()
    assert pairs_of(partial) == {("1", "negative_feedback_low_safety")}


def test_mixed_profiles(labelled):
    assert pairs_of(labels.mixed_profiles(labelled).collect()) == {("b", 2)}


# --- sessions --------------------------------------------------------------------------

# three messages on the first day; on the second, one intent and one tone come out
# differently, and one message is new
INTENTS, TONES, LEVELS = (rules.TAXONOMY[d] for d in ("primary_intent", "message_tone", "safety_level"))
DAY1 = {f"q{i}": (INTENTS[i], TONES[i], LEVELS[i]) for i in range(3)}
DAY2 = DAY1 | {
    "q1": (INTENTS[5], TONES[1], LEVELS[1]),
    "q2": (INTENTS[2], TONES[4], LEVELS[2]),
    "q7": DAY1["q0"],
}
SCHEMA = (
    "session string, message_id string, primary_intent string, message_tone string, "
    "safety_level string, recorded_at int, seq int"
)


@pytest.fixture(scope="module")
def records(spark):
    rows = [("day1", "q1", "GREETING", "FRIENDLY", None, 1, 0)]  # replaced below
    rows += [("day1", m, *v, 2, i) for i, (m, v) in enumerate(DAY1.items())]
    rows += [("day2", m, *v, 3, i) for i, (m, v) in enumerate(DAY2.items())]
    return spark.createDataFrame(rows, SCHEMA)


def test_session_agreement(records):
    scores = agreement.gate_scores(agreement.session_agreement(records, "day1", "day2"))
    got = {r["dimension"]: (r["matches"], r["total"], r["approved"]) for r in scores.collect()}
    assert got == {
        "primary_intent": (2, 3, False),
        "message_tone": (2, 3, False),
        "safety_level": (3, 3, True),
        "overall": (7, 9, False),
    }


def test_no_common_message_gives_no_rows(records):
    assert agreement.session_agreement(records, "day1", "day8").collect() == []


def test_common_messages_without_labels_score_zero(spark):
    df = spark.createDataFrame(
        [("a", "m", "GREETING", None, None, 1, 1), ("b", "m", None, None, None, 1, 1)], SCHEMA
    )
    (row,) = agreement.session_agreement(df, "a", "b").collect()
    assert (row["dimension"], row["total"], row["score"]) == ("overall", 0, 0.0)


def test_latest_recording_replaces_the_whole_record(spark):
    df = spark.createDataFrame(
        [
            ("s", "m", "GREETING", "FRIENDLY", "LEVEL_0_SAFE", 1, 1),
            ("s", "m", "GOODBYE", None, "LEVEL_0_SAFE", 1, 2),
        ],
        SCHEMA,
    )
    (row,) = agreement.latest_annotations(df).collect()
    assert row["primary_intent"] == "GOODBYE" and row["message_tone"] is None


def test_disagreements_find_the_first_control_text(records, spark):
    control = spark.createDataFrame(
        [("q1", "second", 5), ("q1", "first", 1)], "id string, text string, ord int"
    )
    rows = agreement.disagreements(records, "day1", "day2", control=control).collect()
    assert pairs_of(rows) == {
        ("q1", "primary_intent", INTENTS[1], INTENTS[5], "first"),
        ("q2", "message_tone", TONES[2], TONES[4], None),
    }
    assert pairs_of(agreement.shared_messages(records, "day1", "day2").collect()) == {
        ("q0",), ("q1",), ("q2",),
    }


def test_calibration_report(records):
    rows = reports.calibration_report(records, "day1", "day2").collect()
    got = {(r["section"], r["item"]): (r["value"], r["text"]) for r in rows}
    assert got[("summary", "evaluated")][0] == 3
    assert got[("summary", "verdict")] == (pytest.approx(7 / 9), "needs_refinement")
    assert got[("summary", "inconsistent_messages")][0] == 2
    assert got[("agreement", "safety_level")] == (1.0, "pass")
    assert got[("cases", "q2")][1] == f"message_tone: {TONES[2]} → {TONES[4]}"


def fingerprint(ids):
    """The one definition, at any size."""
    digests = [hashlib.md5(f"{i}|{x}".encode()).hexdigest() for i, x in enumerate(ids)]
    words = [sum(int(d[8 * k:8 * k + 8], 16) for d in digests) for k in range(4)]
    return hashlib.md5(":".join(map(str, [len(ids), *words])).encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 30, 1000, 1001, 10_001])
def test_order_fingerprint(spark, n):
    ids = [f"id{i}" for i in range(n)]
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate(ids)], "session string, position long, id string")
    (row,) = agreement.order_fingerprint(df.repartition(5)).collect()
    assert (row["items"], row["fingerprint"]) == (n, fingerprint(ids))
    if n > 1:
        swapped = df.withColumn("position", F.lit(n - 1) - F.col("position"))
        assert agreement.order_fingerprint(swapped).first()["fingerprint"] != row["fingerprint"]


def test_calibration_sessions_share_one_order(spark):
    control = spark.createDataFrame([(f"c{i}", "t") for i in range(30)], "id string, text string")
    rows = agreement.calibration_sessions(control, ["x", "y"], "seed").collect()
    orders = {s: [r["id"] for r in sorted(rows, key=lambda r: r["position"]) if r["session"] == s] for s in "xy"}
    assert orders["x"] == orders["y"] != [f"c{i}" for i in range(30)]
    assert sorted(orders["x"]) == sorted(f"c{i}" for i in range(30))


# --- annotators ------------------------------------------------------------------------


def test_kappa_against_brute_force(spark):
    rng = random.Random(4)
    rows, people = [], ["p", "q", "r", "s"]
    for m in range(300):
        for who in rng.sample(people, rng.randint(1, 4)):
            rows.append((f"m{m}", who, rng.choice("ABC"), rng.choice(["X", "X", "X", None])))
    df = spark.createDataFrame(rows, "message_id string, annotator string, d1 string, d2 string")
    pairs = agreement.annotator_pairs(df, ["d1", "d2"])
    per_message = {}
    for m, who, *values in rows:
        per_message.setdefault(m, {})[who] = values
    tables = {}
    for votes in per_message.values():
        first_two = sorted(votes)[:2]
        if len(first_two) == 2:
            for d in (0, 1):
                a, b = (votes[w][d] for w in first_two)
                if a is not None and b is not None:
                    tables.setdefault((f"d{d + 1}", *first_two), []).append((a, b))
    want = {}
    for key, cells in tables.items():
        n = len(cells)
        left, right = Counter(a for a, _ in cells), Counter(b for _, b in cells)
        po = sum(a == b for a, b in cells) / n
        pe = sum(left[x] * right[x] for x in left) / n**2
        want[key] = (n, None if pe == 1 else (po - pe) / (1 - pe))
    got = {
        (r["dimension"], r["annotator1"], r["annotator2"]): (r["samples"], r["kappa"])
        for r in agreement.kappa_by_pair(pairs).collect()
    }
    assert got.keys() == want.keys()
    for key, (n, kappa) in want.items():
        assert got[key][0] == n
        assert got[key][1] == (None if kappa is None else pytest.approx(kappa))
    cells = agreement.confusion_matrix(pairs).collect()
    assert sum(r["n"] for r in cells) == sum(len(c) for c in tables.values())


def test_first_two_annotators_by_order(spark):
    df = spark.createDataFrame(
        [("m", "zed", "A", 1), ("m", "amy", "B", 3), ("m", "bob", "C", 2), ("m", "zed", "D", 9)],
        "message_id string, annotator string, d string, at int",
    )
    (row,) = agreement.annotator_pairs(df, ["d"], order=["at"]).collect()
    assert (row["annotator1"], row["label1"], row["annotator2"], row["label2"]) == ("bob", "C", "zed", "A")


# --- review ----------------------------------------------------------------------------

ANNOTATION = (
    "message_id string, primary_intent string, message_tone string, safety_level string, "
    "confidence double, response string, text string"
)


def reasons_of(spark, response="", intent="GREETING", tone="ENGAGED", level="LEVEL_0_SAFE", confidence=1.0):
    df = spark.createDataFrame([("m", intent, tone, level, confidence, response, "t")], ANNOTATION)
    (row,) = review.review(df).collect()
    return [r["code"] for r in row["reasons"]]


@pytest.mark.parametrize(
    "response, codes",
    [
        ("Hola. Que tal. Bien.", ["response_too_long"]),
        ("Hola. Que tal.", []),
        ("Hi! \U0001F60A\U0001F60A\U0001F495", ["too_many_emoji"]),
        ("Hi! ❤❤❤ \U0001F60A\U0001F44D\U0001F3FD", ["too_many_emoji"]),
        ("❤❤❤❤", []),
        ("cuesta $25", ["mentions_price"]),
        ("cuesta $ 25", []),
        ("ven a OnlyFans", ["mentions_platform"]),
        ("te lo GARANTIZO", ["makes_promise"]),
        ("enamorado", ["too_intimate"]),
        ("si? no?", ["too_many_questions"]),
        ("si? no? ", []),
        ("si?", []),
        (None, []),
    ],
)
def test_response_rules(spark, response, codes):
    assert reasons_of(spark, response) == codes


@pytest.mark.parametrize(
    "fields, codes",
    [
        ({"confidence": 0.79}, ["low_confidence"]),
        ({"confidence": 0.8}, []),
        ({"confidence": None}, []),
        ({"intent": "TRANSACTIONAL_INQUIRY", "confidence": 0.69},
         ["low_confidence", "low_confidence_transactional"]),
        ({"intent": "TRANSACTIONAL_INQUIRY", "confidence": 0.7}, ["low_confidence"]),
        ({"intent": "NEGATIVE_FEEDBACK", "tone": "FRIENDLY"},
         ["inconsistent:negative_feedback_friendly", "sensitive_intent"]),
        ({"intent": "COMPLIMENT", "tone": "FRUSTRATED"}, ["inconsistent:compliment_frustrated"]),
        ({"level": "LEVEL_3_INAPPROPRIATE"},
         ["inconsistent:inappropriate_positive_tone", "safety_review"]),
        ({"level": "LEVEL_2_BORDERLINE"}, ["safety_review"]),
        ({"intent": None, "tone": None, "level": None}, []),
    ],
)
def test_annotation_rules(spark, fields, codes):
    assert reasons_of(spark, **fields) == codes


@pytest.fixture(scope="module")
def reviewed(spark):
    rng = random.Random(8)
    rows = [
        (
            f"m{i:03d}", rng.choice([*rules.TAXONOMY["primary_intent"], "OTHER"]),
            rng.choice(rules.TAXONOMY["message_tone"]), rng.choice(rules.TAXONOMY["safety_level"]),
            rng.random(), rng.choice(["", "a. b. c.", "$5 amor"]), "t",
        )
        for i in range(120)
    ]
    return review.review(spark.createDataFrame(rows, ANNOTATION)).cache()


def test_ranking_and_examples(reviewed):
    everything = [r for r in reviewed.collect() if r["n_reasons"]]
    best = sorted(everything, key=lambda r: (-r["n_reasons"], r["message_id"]))
    ranked = review.ranked_candidates(reviewed).collect()
    assert [r["message_id"] for r in ranked] == [r["message_id"] for r in best]
    top = review.top_candidates(reviewed).collect()
    assert [r["message_id"] for r in top] == [r["message_id"] for r in best[:20]]
    by_issue = {}
    for row in best[:20]:
        for reason in row["reasons"]:
            by_issue.setdefault(reason["code"].split(":")[0], []).append(row["message_id"])
    want = {(issue, i + 1, m) for issue, ids in by_issue.items() for i, m in enumerate(ids[:3])}
    got = review.examples_by_issue(reviewed).select("issue", "rank", "message_id").collect()
    assert pairs_of(got) == want
    histogram = Counter(x["code"].split(":")[0] for r in everything for x in r["reasons"])
    assert {r["issue"]: r["n"] for r in review.issue_histogram(reviewed).collect()} == histogram


def test_reports_agree_with_the_single_operators(reviewed):
    rows = reports.review_report(reviewed).collect()
    got = {(r["section"], r["item"]): r["value"] for r in rows}
    (rate,) = review.review_rate(reviewed).collect()
    assert got[("summary", "review_rate")] == pytest.approx(rate["rate"])
    for r in review.record_distribution(reviewed).collect():
        assert got[(f"distribution:{r['dimension']}", r["label"])] == pytest.approx(r["share"])
    for r in review.issue_histogram(reviewed).collect():
        assert got[("issues", r["issue"])] == r["n"]
    fired = {r["anomaly"] for r in review.distribution_anomalies(reviewed).collect() if r["fires"]}
    assert {i for s, i in got if s == "anomalies"} == fired
    advice = reports.recommendations(reports.tally(reviewed)).collect()
    assert {i for s, i in got if s == "recommendations"} == {r["advice"] for r in advice}


def test_nothing_to_review(spark):
    empty = review.review(spark.createDataFrame([], ANNOTATION))
    (row,) = review.review_rate(empty).collect()
    assert (row["total"], row["rate"]) == (0, None)
    values = [r["value"] for r in review.distribution_anomalies(empty).collect()]
    assert values == [None, 0.0, None]
    assert all(not r["ok"] for r in gates.tally_gates(reports.tally(empty)).collect())


def test_nested_annotations_get_their_defaults(spark, tmp_path):
    from hushmark.sources.corpus import read_annotations, write_corrections

    (tmp_path / "a.json").write_text(
        '[{"message_id": "x", "annotations": {"primary_intent": "GOODBYE", "message_tone": "FRIENDLY",'
        ' "safety_level": "LEVEL_2_BORDERLINE"}}]'
    )
    flat = review.flat_annotations(read_annotations(spark, str(tmp_path / "a.json")))
    done = review.review(flat)
    (row,) = done.collect()
    assert (row["text"], row["response"]) == ("N/A", "")
    write_corrections(review.correction_records(done), str(tmp_path / "out"))
    (line,) = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert (
        '"human_corrections":{"primary_intent":null,"message_tone":null,"safety_level":null,'
        '"ideal_response":null,"notes":null}'
    ) in line


# --- gates -----------------------------------------------------------------------------


def test_quality_gates(spark):
    rows = [("1", "GREETING", "FRIENDLY", "LEVEL_0_SAFE", 1.0, "", "t")] * 30
    rows += [("2", "GOODBYE", "ENGAGED", "LEVEL_3_INAPPROPRIATE", 1.0, "", "t")] * 10
    df = spark.createDataFrame(rows, ANNOTATION)
    scores = spark.createDataFrame([("overall", 9, 10, 0.9)], "dimension string, matches int, total int, score double")
    found = gates.quality_gates(reports.tally(review.review(df)), scores)
    got = {r["gate"]: (r["value"], r["ok"]) for r in found.collect()}
    assert got["other_share"] == (0.0, True)
    assert got["risk_share"] == (0.25, True)
    assert got["level3_examples"] == (10.0, True)
    assert got["largest_share_primary_intent"] == (0.75, False)
    assert got["review_rate"] == (0.25, False)
    assert got["calibration_agreement"] == (0.9, True)
    none = gates.agreement_gate(scores.where("false")).collect()
    assert [(r["value"], r["ok"]) for r in none] == [(None, False)]


def test_percent_and_bar(spark):
    row = spark.range(1).select(percent(F.lit(0.1225)).alias("p"), bar(F.lit(0.26)).alias("b")).first()
    assert row["p"] == "12.2%" and row["b"] == "█" * 5


# --- guideline rules -------------------------------------------------------------------


def test_keyword_levels_take_the_higher(spark):
    df = spark.createDataFrame([("Eres SEXY",), ("sexys",), ("en la cama, muy vulgar",), (None,)], "text string")
    words = {"LEVEL_2_BORDERLINE": ("sexy", "cama"), "LEVEL_3_INAPPROPRIATE": ("vulgar",)}
    got = [r["keyword_level"] for r in guidelines.keyword_safety(df, words=words).collect()]
    assert got == ["LEVEL_2_BORDERLINE", "LEVEL_0_SAFE", "LEVEL_3_INAPPROPRIATE", "LEVEL_0_SAFE"]


def test_heuristic_intent_priority(spark):
    df = spark.createDataFrame([("pero el precio",), ("pero no",), ("perol",)], "text string")
    got = [r["heuristic_intent"] for r in guidelines.heuristic_intent(df).collect()]
    assert got == ["TRANSACTIONAL_INQUIRY", "HESITATION_OR_OBJECTION", None]


def test_exhausted_leads(spark):
    base = {"status": "LEAD_QUALIFIED", "offers": 3, "positive_answers": 0, "interactions": 21,
            "days_since_offer": 8, "soft_rejections": 0}
    changes = [
        {}, {"status": "PROSPECT"}, {"offers": 2}, {"positive_answers": 1}, {"interactions": 20},
        {"days_since_offer": 7}, {"days_since_offer": 7, "soft_rejections": 2},
        {"days_since_offer": None, "soft_rejections": 2},
    ]
    rows = [(i, *(base | c).values()) for i, c in enumerate(changes)]
    df = spark.createDataFrame(
        rows, "user_id int, status string, offers int, positive_answers int, interactions int, "
        "days_since_offer int, soft_rejections int",
    )
    assert {r["user_id"] for r in guidelines.exhausted_leads(df).collect()} == {0, 6, 7}


def test_user_attributes_skip_missing_values(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, "MX", None), (1, 2, 0, None, "nurse"), (1, 2, 1, "ES", None), (2, 1, 0, None, None)],
        "user_id int, ts int, seq int, country string, job string",
    )
    got = {tuple(r) for r in guidelines.user_attributes(df, ["country", "job"]).collect()}
    assert got == {(1, "ES", "nurse"), (2, None, None)}


def test_vocabulary_orders_ties_by_word(spark):
    df = spark.createDataFrame([("b a  b",), ("c\ta",), ("",)], "text string")
    got = [tuple(r) for r in guidelines.vocabulary(df, n=2).collect()]
    assert got == [("a", 2), ("b", 2)]


def test_rule_tables_are_consistent():
    for edges in (rules.STAGE_EDGES, rules.GUIDELINE_STAGE_EDGES, rules.STATUS_EDGES):
        assert set(itertools.chain(*edges.values())) <= set(edges)
