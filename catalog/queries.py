"""Registered queries: ``(spark, folder) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.functions import draw, guess_language
from hushmark.operators import (
    agreement,
    audit,
    gates,
    guidelines,
    labels,
    messages,
    profile,
    redact,
    review,
    seed,
    transitions,
)
from hushmark.plans import derive, jobs, ordered, reports
from hushmark.rules import labels as label_rules
from hushmark.rules.pii import COUNTED, PII_RULES, PiiRule, select_rules
from hushmark.sources import corpus

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
COUNTS = [f"n_{c}" for c in (*COUNTED, "url")]
ORDER = ["turn", "message_id"]
TIMELINE = ["seconds", "turn"]


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _turns():
    return ordered.RANGED


# --- redaction -----------------------------------------------------------------------


@query
def pii_redact_documents(spark, folder):
    done = redact.redact_messages(derive.documents(spark, folder))
    return done.select("doc_id", "text", *COUNTS, "_anonymized", "_pii_removed_count")


@query
def pii_stats_by_lang(spark, folder):
    return redact.statistics(redact.redact_messages(derive.documents(spark, folder)), "lang")


@query
def pii_stats_by_source(spark, folder):
    return redact.statistics(redact.redact_messages(derive.documents(spark, folder)), "source")


@query
def pii_redact_selected(spark, folder):
    rules = select_rules(["emails", "phones"])
    done = redact.redact_messages(derive.documents(spark, folder), rules=rules)
    return done.select("doc_id", "text", "n_email", "n_phone", "_pii_removed_count")


@query
def pii_redact_pages(spark, folder):
    pages = derive.load(spark, folder, "pages", "page_id")
    done = redact.redact_messages(pages, text="html")
    return done.select("page_id", "html", *COUNTS, "_anonymized", "_pii_removed_count")


@query
def pii_redact_seeded(spark, folder):
    done = redact.redact_messages(derive.seeded(spark, folder))
    return done.select("message_id", "text", *COUNTS, "_anonymized", "_pii_removed_count")


@query
def pii_redact_nested(spark, folder):
    flat = derive.seeded(spark, folder).select(
        "conv_id", "turn", F.struct("message_id", "role", "text").alias("message")
    )
    nested = messages.nest(flat, ["conv_id"], order="turn")
    done = messages.flatten(redact.redact_nested(nested))
    return done.select("conv_id", "message.*")


OWN_RULE = PiiRule("the", r"(?i)\bth[a-z]+\b", "[TH]")


@query
def pii_redact_own_rule(spark, folder):
    """A rule of the user's own runs after the built-in ones and counts like them."""
    rules = (*PII_RULES, OWN_RULE)
    done = redact.redact_messages(derive.documents(spark, folder), rules=rules)
    return redact.statistics(done, "source", rules=rules)


@query
def entity_list_redact_nested(spark, folder):
    base = derive.messages(spark, folder)
    with_names = redact.attach_entities(base, derive.entity_mentions(spark, folder), "message_id")
    flat = with_names.select("conv_id", "turn", F.struct("message_id", "text", "entities").alias("message"))
    done = redact.redact_nested(messages.nest(flat, ["conv_id"], order="turn"), entities="entities")
    return messages.flatten(done).select("conv_id", "message.message_id", "message.text", "message._pii_removed_count")


@query
def entity_list_redact(spark, folder):
    base = derive.messages(spark, folder)
    with_names = redact.attach_entities(
        base, derive.entity_mentions(spark, folder), "message_id"
    )
    done = redact.redact_messages(with_names, entities="entities", mentions="n_mentions")
    return done.select("message_id", "text", "n_name", "_anonymized", "_pii_removed_count")


@query
def secret_marker_lines(spark, folder):
    return audit.marked_lines(derive.lined_documents(spark, folder), "doc_id", "source")


@query
def secret_marker_counts(spark, folder):
    lined = audit.marked_lines(derive.lined_documents(spark, folder), "source")
    return lined.groupBy("source").agg(F.count(F.lit(1)).alias("lines"))


# --- seeding and audit ---------------------------------------------------------------


@query
def pii_seed_messages(spark, folder):
    truth = [
        F.try_element_at(F.col(f"{redact.TEST_COLUMN}.{f}"), F.lit(1)).alias(f)
        for f in ("names", "emails", "phones", "socials", "addresses")
    ]
    return derive.seeded(spark, folder).select(
        "message_id", "text", "seed_lang", "seed_template", *truth
    )


@query
def pii_seed_nested(spark, folder):
    done = messages.flatten(seed.seed_nested(_nested(spark, folder), keys=["conv_id"]))
    truth = [
        F.try_element_at(F.col(f"message.{redact.TEST_COLUMN}.{f}"), F.lit(1)).alias(f)
        for f in ("names", "emails", "phones", "socials", "addresses")
    ]
    return done.select("conv_id", "message.message_id", "message.text", *truth)


@query
def message_language(spark, folder):
    return derive.documents(spark, folder).groupBy(
        "lang", guess_language(F.col("text")).alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def seeding_totals(spark, folder):
    totals = seed.seeding_totals(derive.seeded(spark, folder), "role", conversation="conv_id")
    return totals.withColumn("percent_seeded", F.round("percent_seeded", 6))


@query
def seeding_values(spark, folder):
    return seed.seeding_details(derive.seeded(spark, folder), "role")


@query
def pii_recall(spark, folder):
    return audit.recall(derive.seeded(spark, folder), "category", "value").withColumn(
        "recall", F.round("recall", 9)
    )


@query
def pii_recall_by_template(spark, folder):
    by = ["seed_lang", "seed_template", "category"]
    return audit.recall(derive.seeded(spark, folder), *by).withColumn(
        "recall", F.round("recall", 9)
    )


@query
def pii_residual_audit(spark, folder):
    both = audit.before_and_after(derive.seeded(spark, folder), "role")
    return audit.residual_summary(both, "stage", "role")


@query
def pii_residual_details(spark, folder):
    found = audit.residual_details(derive.seeded(spark, folder), "message_id")
    return found.select(
        "message_id", *[F.array_join(a, "|").alias(a) for a in ("emails", "phones", "socials", "names")]
    )


def _damaged(spark, folder):
    """The redacted corpus with some roles changed and some messages lost.

    The original table is whole; without a second one that differs there were nothing to find.
    """
    done = redact.redact_messages(derive.seeded(spark, folder))
    kept = done.where(draw(50, "lost", *derive.KEYS) > 0)
    role = F.when(draw(50, "role", *derive.KEYS) == 0, "unknown").otherwise(F.col("role"))
    return kept.withColumn("role", role)


@query
def structure_diff(spark, folder):
    return audit.structure_differences(
        derive.messages(spark, folder), _damaged(spark, folder), ["conv_id", "turn"], ["message_id", "role"]
    )


@query
def structure_preserved(spark, folder):
    original = derive.messages(spark, folder)
    done = redact.redact_messages(derive.seeded(spark, folder))
    found = audit.structure_differences(original, done, ["conv_id", "turn"], ["message_id", "role"])
    return found.agg(F.count(F.lit(1)).alias("differences"))


@query
def structure_counts(spark, folder):
    return audit.structure_counts(
        derive.messages(spark, folder), _damaged(spark, folder), "conv_id"
    )


@query
def structure_rows_changed(spark, folder):
    return audit.rows_changed(
        derive.messages(spark, folder), _damaged(spark, folder), ["conv_id", "turn", "role"]
    )


# --- corpus shape --------------------------------------------------------------------


def _nested(spark, folder):
    flat = derive.messages(spark, folder).select(
        "conv_id", "turn", F.struct("message_id", "role", "text").alias("message")
    )
    return messages.nest(flat, ["conv_id"], order="turn")


@query
def flatten_messages(spark, folder):
    flat = messages.with_text(messages.flatten(_nested(spark, folder)), "message.text")
    return flat.select("conv_id", "pos", "message.message_id", "message.role")


@query
def conversation_length_filter(spark, folder):
    kept = messages.within_length(derive.messages(spark, folder), "conv_id")
    return kept.select("conv_id", "turn", "message_id")


@query
def conversation_length_filter_nested(spark, folder):
    kept = messages.nested_within_length(_nested(spark, folder))
    return kept.where("part = 0").select("conv_id", "n_messages")


@query
def label_tool_tasks(spark, folder):
    nested = _nested(spark, folder).withColumnRenamed("conv_id", "conversation_id")
    tasks = corpus.label_tasks(nested)
    first = messages.first_samples("data.messages")
    return tasks.where("meta.part = 0").select(
        F.col("data.conversation_id").alias("conversation_id"),
        F.col("meta.n_messages").alias("n_messages"),
        F.array_join(F.transform(first, lambda m: m["role"]), "|").alias("first_roles"),
    )


@query
def run_record(spark, folder):
    return jobs.run_record(derive.documents(spark, folder), "1.0", source="source", stamp=False)


@query
def json_root_profile(spark, folder):
    return profile.root_profile(derive.event_documents(spark, folder), "json")


@query
def json_key_profile(spark, folder):
    return profile.key_profile(derive.event_documents(spark, folder), "json")


@query
def json_inner_keys(spark, folder):
    return profile.inner_key_profile(derive.event_documents(spark, folder), "json")


@query
def json_shape_profile(spark, folder):
    return profile.key_profile(derive.events(spark, folder), "props")


@query
def json_samples(spark, folder):
    return profile.key_samples(derive.event_documents(spark, folder), "json", "event_id")


# --- labels --------------------------------------------------------------------------


@query
def label_distribution(spark, folder):
    shares = labels.distribution(derive.annotations(spark, folder))
    return labels.sorted_distribution(shares).withColumn("share", F.round("share", 9))


@query
def label_distribution_all(spark, folder):
    shares = review.record_distribution(derive.annotations(spark, folder))
    return shares.withColumn("share", F.round("share", 9))


@query
def label_domain_violations(spark, folder):
    return labels.domain_violations(derive.annotations(spark, folder), "message_id")


@query
def label_conflicts(spark, folder):
    return labels.conflicts(derive.annotations(spark, folder), "message_id")


@query
def label_conflict_counts(spark, folder):
    return labels.conflict_counts(derive.annotations(spark, folder))


@query
def mixed_profiles(spark, folder):
    return labels.mixed_profiles(derive.annotations(spark, folder), "conv_id")


@query
def label_report(spark, folder):
    report = reports.label_report(derive.annotations(spark, folder), "conv_id", ORDER, _turns())
    return report.withColumn("value", F.round("value", 9))


def _given_labels(spark, folder):
    """The given labels of documents, as text, with their document's language."""
    found = derive.load(spark, folder, "labels", "doc_id").select(
        "doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic")
    )
    return found.join(derive.documents(spark, folder).select("doc_id", "lang"), "doc_id")


GIVEN = ("quality", "toxic")


@query
def given_label_distribution(spark, folder):
    shares = labels.distribution(_given_labels(spark, folder), GIVEN)
    return shares.withColumn("share", F.round("share", 9))


@query
def given_label_domain(spark, folder):
    """Labels outside 0 and 1, and as every table needs a counter-example, quality outside {1}."""
    rows = _given_labels(spark, folder)
    wrong = labels.domain_violations(rows, "doc_id", taxonomy={"quality": ("0", "1"), "toxic": ("0", "1")})
    odd = labels.domain_violations(rows, "doc_id", taxonomy={"quality": ("1",)})
    return wrong.withColumn("check", F.lit("binary")).unionByName(odd.withColumn("check", F.lit("good")))


@query
def given_label_balance(spark, folder):
    counts = labels.distribution(_given_labels(spark, folder), GIVEN).select(
        F.col("dimension").alias("section"), F.col("label").alias("item"), "n"
    )
    return gates.balance_gates(counts, GIVEN).withColumn("value", F.round("value", 9))


@query
def given_label_confusion(spark, folder):
    return _given_labels(spark, folder).groupBy("lang", "quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query
def annotation_records(spark, folder):
    """Annotation records as JSON text, parsed by the declared schema and flattened."""
    rows = derive.annotations(spark, folder)
    record = F.to_json(
        F.struct(
            "message_id",
            F.when(draw(4, "no_text", *derive.KEYS) > 0, F.col("text")).alias("original_text"),
            F.struct("primary_intent", "message_tone", "safety_level", "confidence").alias("annotations"),
            F.when(draw(4, "no_response", *derive.KEYS) > 0, F.struct(F.col("response").alias("text"))).alias("ideal_response"),
        )
    )
    parsed = rows.select(F.from_json(record, corpus.ANNOTATION).alias("r")).select("r.*")
    return review.flat_annotations(parsed).drop("reasoning")


# --- state machines ------------------------------------------------------------------


@query
def stage_pairs(spark, folder):
    pairs = transitions.state_pairs(
        derive.annotations(spark, folder), "conv_id", "rapport_stage", ORDER, _turns()
    )
    return pairs.select("conv_id", "position", "rapport_stage", "next_rapport_stage")


def _invalid_stages(spark, folder, **options):
    return transitions.invalid_transitions(
        derive.annotations(spark, folder), "conv_id", "rapport_stage", ORDER, _turns(), **options
    )


@query
def stage_invalid_transitions(spark, folder):
    return _invalid_stages(spark, folder)


@query
def stage_invalid_transitions_guideline(spark, folder):
    return _invalid_stages(spark, folder, edges=label_rules.GUIDELINE_STAGE_EDGES)


@query
def stage_invalid_transitions_allow_self(spark, folder):
    return _invalid_stages(spark, folder, allow_self=True)


@query
def stage_invalid_transitions_gap(spark, folder):
    waited = F.col("next_seconds") - F.col("seconds") >= 900
    return transitions.invalid_transitions(
        derive.annotations(spark, folder), "conv_id", "rapport_stage", TIMELINE,
        F.floor(F.col("seconds") / 86_400), edges=label_rules.GUIDELINE_STAGE_EDGES,
        gap=(label_rules.GAP_EDGES, waited),
    )


@query
def status_invalid_transitions(spark, folder):
    history = derive.user_history(spark, folder)
    return transitions.invalid_transitions(
        history, "user_id", "customer_status", ["ts", "seq"],
        ordered.RANGED, edges=label_rules.STATUS_EDGES,
    )


@query
def first_invalid_transitions(spark, folder):
    return transitions.first_transitions(_invalid_stages(spark, folder), "conv_id")


# --- agreement -----------------------------------------------------------------------


def _control(spark, folder):
    return derive.messages(spark, folder).select(
        F.col("message_id").alias("id"), "text", F.col("turn").alias("ord")
    )


@query
def latest_annotation(spark, folder):
    return agreement.latest_annotations(derive.session_records(spark, folder))


@query
def shared_messages(spark, folder):
    return agreement.shared_messages(derive.session_records(spark, folder), "day1", "day2")


@query
def agreement_by_dimension(spark, folder):
    scores = agreement.session_agreement(derive.session_records(spark, folder), "day1", "day2")
    return agreement.gate_scores(scores).withColumn("score", F.round("score", 9))


@query
def disagreements(spark, folder):
    return agreement.disagreements(
        derive.session_records(spark, folder), "day1", "day2", control=_control(spark, folder)
    )


@query
def calibration_report(spark, folder):
    report = reports.calibration_report(
        derive.session_records(spark, folder), "day1", "day2", _control(spark, folder)
    )
    return report.withColumn("value", F.round("value", 9))


@query
def calibration_sessions(spark, folder):
    rows = agreement.calibration_sessions(_control(spark, folder), ["day1", "day2"], "bank")
    return rows.select("session", "position", "id")


@query
def session_fingerprint(spark, folder):
    items = derive.messages(spark, folder).select(
        F.col("conv_id").alias("session"), F.col("turn").alias("position"),
        F.col("message_id").alias("id"),
    )
    return agreement.order_fingerprint(items)


@query
def bank_fingerprint(spark, folder):
    rows = agreement.calibration_sessions(_control(spark, folder), ["day1", "day2"], "bank")
    return agreement.order_fingerprint(rows)


def _pairs(spark, folder):
    return agreement.annotator_pairs(
        derive.annotator_labels(spark, folder), label_rules.SESSION_DIMENSIONS
    )


@query
def kappa_by_pair(spark, folder):
    kappas = agreement.kappa_by_pair(_pairs(spark, folder))
    return kappas.withColumns({c: F.round(c, 9) for c in ("observed", "expected", "kappa")})


@query
def kappa_summary(spark, folder):
    summary = agreement.kappa_summary(agreement.kappa_by_pair(_pairs(spark, folder)))
    return summary.withColumns({c: F.round(c, 9) for c in ("mean_kappa", "min_kappa")})


@query
def confusion_matrix(spark, folder):
    return agreement.confusion_matrix(_pairs(spark, folder))


# --- review --------------------------------------------------------------------------


def _reviewed(spark, folder):
    return review.review(derive.annotations(spark, folder))


@query
def response_quality(spark, folder):
    rows = review.with_response_quality(derive.annotations(spark, folder))
    details = F.col("reasons.detail")
    return rows.select(
        "message_id",
        review.reason_codes().alias("codes"),
        F.aggregate(details, F.lit(0.0), lambda s, d: s + F.coalesce(d, F.lit(0.0))).alias("details"),
    )


@query
def annotation_consistency(spark, folder):
    rows = review.with_consistency(derive.annotations(spark, folder))
    flagged = rows.where(F.array_size("reasons") > 0)
    return flagged.select("message_id", review.reason_codes().alias("codes"))


@query
def review_candidates(spark, folder):
    rows = review.ranked_candidates(_reviewed(spark, folder))
    return rows.select("message_id", "n_reasons", review.reason_codes().alias("codes"))


@query
def review_top20(spark, folder):
    rows = review.top_candidates(_reviewed(spark, folder))
    return rows.select("message_id", "n_reasons", review.reason_codes().alias("codes"))


@query
def review_examples_by_issue(spark, folder):
    rows = review.examples_by_issue(_reviewed(spark, folder))
    return rows.select("issue", "rank", "message_id", F.col("reason.code").alias("code"))


@query
def review_rate(spark, folder):
    return review.review_rate(_reviewed(spark, folder)).withColumn("rate", F.round("rate", 9))


@query
def review_issue_histogram(spark, folder):
    return review.issue_histogram(_reviewed(spark, folder))


@query
def distribution_anomalies(spark, folder):
    found = review.distribution_anomalies(derive.annotations(spark, folder))
    return found.withColumn("value", F.round("value", 9))


@query
def quality_gates(spark, folder):
    scores = agreement.session_agreement(derive.session_records(spark, folder), "day1", "day2")
    found = gates.quality_gates(reports.tally(_reviewed(spark, folder)), scores)
    return found.withColumn("value", F.round("value", 9))


@query
def recommendations(spark, folder):
    found = reports.recommendations(reports.tally(_reviewed(spark, folder)))
    return found.withColumn("value", F.round("value", 9))


@query
def quick_stats(spark, folder):
    return reports.quick_stats(_reviewed(spark, folder)).select(
        "section", "item", F.round("value", 9).alias("value"), "text"
    )


@query
def review_report(spark, folder):
    return reports.review_report(_reviewed(spark, folder)).select(
        "section", "item", F.round("value", 9).alias("value"), "text"
    )


@query
def correction_export(spark, folder):
    return review.correction_records(_reviewed(spark, folder)).select(
        "message_id", "text", "llm_annotations.*", "llm_response",
        review.reason_codes("issues").alias("issues"),
        *[F.col(f"human_corrections.{c}").alias(f"human_{c}") for c in review.rules.CORRECTION_FIELDS],
    )


# --- guideline rules -----------------------------------------------------------------


@query
def safety_keyword_level(spark, folder):
    rows = guidelines.keyword_safety(derive.utterances(spark, folder))
    return rows.select("message_id", "keyword_level")


@query
def heuristic_intent(spark, folder):
    rows = guidelines.heuristic_intent(derive.utterances(spark, folder))
    return rows.select("message_id", "heuristic_intent")


@query
def short_replies(spark, folder):
    return guidelines.short_replies(derive.utterances(spark, folder), "message_id")


@query
def repeated_greetings(spark, folder):
    return guidelines.repeated_greetings(
        derive.utterances(spark, folder), "conv_id", ORDER, _turns(), "message_id"
    )


@query
def safety_escalation(spark, folder):
    rows = guidelines.safety_escalation(
        derive.annotations(spark, folder), "conv_id", "seconds", at_least=2, span=1800
    )
    return rows.select("message_id", "recent")


# what stands for offers and answers in the event types of the given table
LEAD_KINDS = {"offer": ["view", "click"], "positive": ["purchase"], "rejection": ["error"]}


def _activity(spark, folder):
    status = guidelines.user_attributes(
        derive.user_history(spark, folder), ["customer_status"]
    ).withColumnRenamed("customer_status", "status")
    events = derive.events(spark, folder)
    return guidelines.lead_activity(events, kinds=LEAD_KINDS).join(status, "user_id")


@query
def lead_activity(spark, folder):
    return _activity(spark, folder)


@query
def exhausted_leads(spark, folder):
    return guidelines.exhausted_leads(_activity(spark, folder)).select("user_id", "interactions")


@query
def user_attributes(spark, folder):
    return guidelines.user_attributes(
        derive.user_history(spark, folder), ["user_country", "user_occupation", "customer_status"]
    )


@query
def vocabulary_topk(spark, folder):
    return guidelines.vocabulary(derive.documents(spark, folder))
