"""Agreement of one annotator over time, and between annotators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushmark.functions import text_array
from hushmark.plans.ordered import RANGED, number_rows
from hushmark.rules import labels as rules

DIMENSIONS = rules.SESSION_DIMENSIONS
RECORDED = ("recorded_at", "seq")


def latest_annotations(
    records: DataFrame,
    keys: Sequence[str] = ("session", "message_id"),
    dimensions: Sequence[str] = DIMENSIONS,
    recorded: Sequence[str] = RECORDED,
) -> DataFrame:
    """The last recording per session and message; it replaces the earlier ones whole.

    An aggregate, not a window: earlier recordings are dropped before the shuffle.
    """
    last = F.max_by(F.struct(*dimensions), F.struct(*recorded))
    return (
        records.groupBy(*keys)
        .agg(last.alias("_last"))
        .select(*keys, *[F.col(f"_last.{d}").alias(d) for d in dimensions])
    )


def paired_sessions(
    records: DataFrame,
    first: str,
    second: str,
    dimensions: Sequence[str] = DIMENSIONS,
    recorded: Sequence[str] = RECORDED,
) -> DataFrame:
    """Messages annotated in both sessions, with structs ``a`` and ``b`` of their labels.

    Latest recording and pairing are one aggregate per message: one shuffle, no join.
    """

    def last_in(session: str) -> Column:
        mine = F.col("session") == session
        return F.max_by(
            F.when(mine, F.struct(*dimensions)), F.when(mine, F.struct(*recorded))
        )

    return (
        records.where(F.col("session").isin(first, second))
        .groupBy("message_id")
        .agg(last_in(first).alias("a"), last_in(second).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
    )


def shared_messages(records: DataFrame, first: str, second: str) -> DataFrame:
    """Messages that occur in both sessions."""

    def ids(session: str) -> DataFrame:
        return records.where(F.col("session") == session).select("message_id")

    return ids(first).intersect(ids(second))


def session_agreement(
    records: DataFrame, first: str, second: str, dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """Matches, comparisons and score per dimension and ``overall``.

    A dimension counts where both sessions have it, and is left out when none does.
    Without a common message there are no rows.
    """
    pairs = paired_sessions(records, first, second, dimensions)

    def both(d: str) -> Column:
        return F.col(f"a.{d}").isNotNull() & F.col(f"b.{d}").isNotNull()

    sums = [F.count(F.lit(1)).alias("common")]
    for d in dimensions:
        sums.append(F.count_if(both(d)).alias(f"total_{d}"))
        sums.append(F.count_if(F.col(f"a.{d}") == F.col(f"b.{d}")).alias(f"same_{d}"))
    one_row = pairs.agg(*sums)

    def entry(name: str, same: Column, total: Column) -> Column:
        return F.struct(
            F.lit(name).alias("dimension"), same.alias("matches"), total.alias("total")
        )

    everything = sum([F.col(f"total_{d}") for d in dimensions], F.lit(0))
    same = sum([F.col(f"same_{d}") for d in dimensions], F.lit(0))
    entries = [entry(d, F.col(f"same_{d}"), F.col(f"total_{d}")) for d in dimensions]
    entries.append(entry("overall", same.cast("bigint"), everything.cast("bigint")))
    rows = one_row.where("common > 0").select(F.inline(F.array(*entries)))
    score = F.when(F.col("total") > 0, F.col("matches") / F.col("total")).otherwise(F.lit(0.0))
    return rows.where((F.col("total") > 0) | (F.col("dimension") == "overall")).select(
        "dimension", "matches", "total", score.alias("score")
    )


def gate_scores(agreement: DataFrame, threshold: float = rules.AGREEMENT_GATE) -> DataFrame:
    """Add ``approved``: the score reaches the threshold; no score fails."""
    return agreement.withColumn(
        "approved", F.coalesce(F.col("score"), F.lit(0.0)) >= threshold
    )


def disagreements(
    records: DataFrame,
    first: str,
    second: str,
    dimensions: Sequence[str] = DIMENSIONS,
    control: DataFrame | None = None,
) -> DataFrame:
    """One row per message and dimension labelled differently, with the control text if known.

    ``control`` holds ``id, text, ord``; the first item of an id counts.
    """
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"a.{d}") != F.col(f"b.{d}"),
                    F.struct(
                        F.lit(d).alias("dimension"),
                        F.col(f"a.{d}").alias("label1"),
                        F.col(f"b.{d}").alias("label2"),
                    ),
                )
                for d in dimensions
            ]
        )
    )
    rows = paired_sessions(records, first, second, dimensions).select(
        "message_id", F.inline(entries)
    )
    if control is None:
        return rows.withColumn("text", F.lit(None).cast("string"))
    items = control.groupBy(F.col("id").alias("message_id")).agg(
        F.min_by("text", "ord").alias("text")
    )
    return rows.join(items, "message_id", "left")


def annotator_pairs(
    labels: DataFrame,
    dimensions: Sequence[str],
    message: str = "message_id",
    annotator: str = "annotator",
    order: Sequence[str] = (),
) -> DataFrame:
    """The first two annotators of each message side by side.

    ``order`` says who comes first (default: by name); an annotator's first label
    counts.  At most two rows per message and task are shuffled, whatever the number
    of annotators.
    """
    rank_by = [*order, annotator]
    one_each = labels.where(F.col(annotator).isNotNull()).groupBy(message, annotator).agg(
        F.min_by(F.struct(*dimensions), F.struct(*(order or dimensions))).alias("_labels"),
        *[F.min(c).alias(c) for c in order],
    )
    ranked = Window.partitionBy(message).orderBy(*rank_by)
    two = one_each.withColumn("_rank", F.row_number().over(ranked)).where("_rank <= 2")
    # names in order, so that a pair of annotators is always the same pair
    named = F.struct(F.col(annotator).alias("who"), F.col("_labels").alias("labels"))
    pairs = (
        two.groupBy(message)
        .agg(
            F.min_by(named, annotator).alias("x"),
            F.max_by(named, annotator).alias("y"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where("_n = 2")
    )
    return pairs.select(
        message,
        F.col("x.who").alias("annotator1"),
        F.col("y.who").alias("annotator2"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(d).alias("dimension"),
                        F.col(f"x.labels.{d}").alias("label1"),
                        F.col(f"y.labels.{d}").alias("label2"),
                    )
                    for d in dimensions
                ]
            )
        ),
    ).where(F.col("label1").isNotNull() & F.col("label2").isNotNull())


def confusion_matrix(pairs: DataFrame, *by: str) -> DataFrame:
    """How often two labels meet, per dimension (and pair, if asked)."""
    return pairs.groupBy(*by, "dimension", "label1", "label2").agg(
        F.count(F.lit(1)).alias("n")
    )


def kappa_by_pair(pairs: DataFrame) -> DataFrame:
    """Cohen's kappa per dimension and annotator pair over their shared messages.

    Observed and chance agreement come from the label margins, which are summed from
    the confusion counts.  Kappa is null where chance agreement is certain.
    """
    group = ["dimension", "annotator1", "annotator2"]
    cells = confusion_matrix(pairs, "annotator1", "annotator2")
    same = F.when(F.col("label1") == F.col("label2"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")

    def margin(label: str, first: Column, second: Column, both: Column) -> Column:
        return F.struct(
            F.col(label).alias("label"), first.alias("first"), second.alias("second"),
            both.cast("bigint").alias("both"),
        )

    margins = (
        cells.select(
            *group,
            F.inline(F.array(
                margin("label1", F.col("n"), zero, same), margin("label2", zero, F.col("n"), zero)
            )),
        )
        .groupBy(*group, "label")
        .agg(*[F.sum(c).alias(c) for c in ("first", "second", "both")])
    )
    total = F.sum("first").cast("double")
    chance = F.sum(F.col("first").cast("double") * F.col("second"))
    scores = margins.groupBy(*group).agg(
        F.sum("first").alias("samples"),
        (F.sum("both") / total).alias("observed"),
        (chance / (total * total)).alias("expected"),
    )
    certain = F.round("expected", 12) >= 1.0
    kappa = (F.col("observed") - F.col("expected")) / (1 - F.col("expected"))
    return scores.withColumn("kappa", F.when(~certain, kappa))


def kappa_summary(kappas: DataFrame) -> DataFrame:
    """Mean and lowest kappa over the pairs, and the compared messages, per dimension."""
    return kappas.groupBy("dimension").agg(
        F.avg("kappa").alias("mean_kappa"),
        F.min("kappa").alias("min_kappa"),
        F.sum("samples").alias("samples"),
        F.count(F.lit(1)).alias("pairs"),
    )


def shuffled_bank(control: DataFrame, seed: str, id_column: str = "id") -> DataFrame:
    """The control items in a repeatable random order: adds 0-based ``position``."""
    mixed = control.withColumn("_mix", F.md5(F.concat_ws("|", F.lit(seed), F.col(id_column))))
    return number_rows(mixed, [], ["_mix", id_column], RANGED).drop("_mix")


def calibration_sessions(
    control: DataFrame, sessions: Sequence[str], seed: str
) -> DataFrame:
    """Control items without labels, once per session; all sessions share one order."""
    bank = shuffled_bank(control, seed)
    return bank.select(
        F.explode(text_array(sessions)).alias("session"), "position", "id", "text",
        F.current_timestamp().alias("started_at"),
    )


def order_fingerprint(
    items: DataFrame, group: str = "session", position: str = "position", item: str = "id"
) -> DataFrame:
    """Digest of the ids of a session in their order, by one definition at every size.

    Each ``position|id`` is hashed by md5. The four 32-bit words of the hashes are summed over the
    session, and the md5 of the number of items and the four sums, joined by colons, is the
    fingerprint. Sums combine before the shuffle, so no task gathers a session. A missing id counts as
    an empty one.
    """
    place = F.md5(F.concat_ws("|", F.col(position).cast("string"), F.coalesce(F.col(item).cast("string"), F.lit(""))))
    words = [F.conv(F.substring("_place", 8 * k + 1, 8), 16, 10).cast("decimal(20,0)") for k in range(4)]
    sums = items.withColumn("_place", place).groupBy(group).agg(
        F.count(F.lit(1)).alias("items"), *[F.sum(w).alias(f"_w{k}") for k, w in enumerate(words)]
    )
    parts = [F.col(c).cast("string") for c in ("items", "_w0", "_w1", "_w2", "_w3")]
    return sums.select(group, "items", F.md5(F.concat_ws(":", *parts)).alias("fingerprint"))
