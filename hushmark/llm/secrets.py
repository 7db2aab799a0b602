"""Secret scans: fixed patterns, then multipart credential linking inside scopes.

Base spans, leftmost and non-overlapping per kind, in code points with the end exclusive:

* ``assign``: a key word (either case), an optional quote, blanks, ``:`` or ``=``, blanks, an optional
  quote and a value; kept when the value (group 2) has 12 or more characters;
* ``access``: ``AKIA`` and capitals or digits, 18 or more characters;
* ``hex``: a run of lower-case hexadecimal digits, 16 or more characters.

A match that fails its length still takes its place: the next match of that kind begins after it.

Linking adds spans that alone are too weak to report. A text is cut into scopes at blank lines (a line
break, blanks, a line break). Inside a scope the parts of a credential are found apart:

* identifiers: ``access`` spans that pass, and ``user``/``login``/``client_id`` assignments;
* endpoints: ``scheme://host`` and ``host=`` assignments;
* weak secrets: runs of exactly 40 characters of ``[A-Za-z0-9+/]`` (``aws_secret``), and short
  ``pass``/``pwd``/``pw`` assignments of 6 or more characters (``password``).

A weak ``aws_secret`` is reported when its scope holds an identifier of kind ``access``; a weak
``password`` when its scope holds an endpoint or a user. Parts are joined to candidates through their
scope, an interval of the text, never pair by pair: a scope's flags are one aggregate over its spans.

Everything runs in Spark SQL functions: the matches of a kind come from ``regexp_extract_all``, the text
between them from ``split`` by the same pattern, and a running sum over both gives each match's place.

Defined cases: a null text counts as empty and gives no spans; every input row gives one output row
(nulls and repeated ids included, each row on its own); extra input columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hushmark.llm.common import table


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: the group whose length is checked (0: the whole match)
    group: int
    least: int
    most: int | None
    #: base: reported alone; weak: reported when linked; part: never reported, only links
    role: str
    #: the same matches with the length inside the pattern: only passing matches are found, at the same places
    scan: str = ""


# The base patterns and their lengths, as the contract gives them.
ASSIGN = Kind("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, None, "base",
              r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{12,})")
ACCESS = Kind("access", r"AKIA[A-Z0-9]+", 0, 18, None, "base", r"AKIA[A-Z0-9]{14,}")
HEX = Kind("hex", r"[0-9a-f]+", 0, 16, None, "base", r"[0-9a-f]{16,}")

# The linking method's own parts and candidates.
AWS_SECRET = Kind("aws_secret", r"[A-Za-z0-9+/]+", 0, 40, 40, "weak", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])")
PASSWORD = Kind("password", r"(?i)(pass|pwd|pw)[\"']?\x20*[:=]\x20*[\"']?([^\x20\x09-\x0D\"']+)", 2, 6, None, "weak",
                r"(?i)(pass|pwd|pw)[\"']?\x20*[:=]\x20*[\"']?([^\x20\x09-\x0D\"']{6,})")
USER = Kind("user", r"(?i)(user|username|login|client_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]+)", 2, 3, None, "part",
            r"(?i)(user|username|login|client_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]{3,})")
#: a scheme of at most 16 characters: an open length would try every start against the whole rest (quadratic)
URL = Kind("url", r"[A-Za-z][A-Za-z0-9+.-]{0,15}://[^\x20\x09-\x0D/\"'<>]+", 0, 4, None, "part")
HOST = Kind("host", r"(?i)(host|hostname|endpoint|server)\x20*[:=]\x20*[\"']?([A-Za-z0-9.-]+)", 2, 3, None, "part",
            r"(?i)(host|hostname|endpoint|server)\x20*[:=]\x20*[\"']?([A-Za-z0-9.-]{3,})")
#: What ends a scope.
BREAK = Kind("break", r"\n[\x20\x09\x0B\x0C\x0D]*\n", 0, 0, None, "break")

BASE = (ASSIGN, ACCESS, HEX)
KINDS = (*BASE, AWS_SECRET, PASSWORD, USER, URL, HOST, BREAK)
#: Rank of each kind: spans at one place are ordered by it (the base kinds as listed).
RANK = {k.name: i for i, k in enumerate(KINDS)}


def _arrays(text: Column, kind: Kind) -> list[Column]:
    """The passing matches of a kind, their checked groups and the texts between them, as three array columns.

    The scan pattern finds only matches that pass, at the places where the plain pattern finds them: a
    failing match could only hide a later one inside itself, and that one would fail too (its value ends
    where the outer value ends). So no failing match is ever exploded into a row.
    """
    scan = kind.scan or kind.pattern
    whole = F.regexp_extract_all(text, F.lit(scan), 0)
    part = whole if kind.group == 0 else F.regexp_extract_all(text, F.lit(scan), kind.group)
    return [whole.alias(f"m{kind.name}"), part.alias(f"p{kind.name}"), F.split(text, scan, -1).alias(f"g{kind.name}")]


def _matches(kind: Kind) -> Column:
    """Array of (rank, i, gap, len, checked) for the matches of one kind, in order.

    The arrays are columns already, so that the lambda reads them rather than matching again per element.
    """
    gaps, part = F.col(f"g{kind.name}"), F.col(f"p{kind.name}")
    return F.transform(
        F.col(f"m{kind.name}"),
        lambda m, i: F.struct(
            F.lit(RANK[kind.name]).alias("rank"),
            i.alias("i"),
            F.char_length(F.get(gaps, i)).cast("long").alias("gap"),
            F.char_length(m).cast("long").alias("len"),
            F.char_length(F.get(part, i)).cast("long").alias("checked"),
        ),
    )


def _passes(kind: Kind) -> Column:
    ok = F.col("checked") >= kind.least
    return ok & (F.col("checked") <= kind.most) if kind.most is not None else ok


def spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Every match of every kind: (row, doc_id, kind, rank, start, end, passes, scope); rows without any: one null row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    arrays = rows.select("row", "doc_id", *[a for k in kinds for a in _arrays(F.col("t"), k)])
    found = arrays.select("row", "doc_id", F.explode_outer(F.concat(*[_matches(k) for k in kinds])).alias("m"))
    # all spans of a row in one task: every window and the grouping below share this one shuffle
    flat = found.select("row", "doc_id", "m.*").repartition("row")
    by_kind = Window.partitionBy("row", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(by_kind)).withColumn("start", F.col("end") - F.col("len"))
    passes = F.lit(False)
    for k in kinds:
        passes = F.when(F.col("rank") == RANK[k.name], _passes(k)).otherwise(passes)
    is_break = (F.col("rank") == RANK[BREAK.name]).cast("int")
    by_place = Window.partitionBy("row").orderBy("start", F.desc(is_break)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select(
        "row", "doc_id", "rank", "start", "end", F.coalesce(passes, F.lit(False)).alias("passes"),
        F.coalesce(F.sum(is_break).over(by_place), F.lit(0)).alias("scope"),
    )


def linked(found: DataFrame) -> DataFrame:
    """``found`` with ``reported``: base spans that pass, weak ones whose scope holds their complement."""
    scope = Window.partitionBy("row", "scope")
    flag = lambda *kinds: F.max(F.col("passes") & F.col("rank").isin(*[RANK[k.name] for k in kinds])).over(scope)
    rank = F.col("rank")
    reported = (
        F.when(rank.isin(*[RANK[k.name] for k in BASE]), F.col("passes"))
        .when(rank == RANK[AWS_SECRET.name], F.col("passes") & flag(ACCESS))
        .when(rank == RANK[PASSWORD.name], F.col("passes") & flag(URL, HOST, USER))
        .otherwise(F.lit(False))
    )
    return found.withColumn("reported", F.coalesce(reported, F.lit(False)))


def _joined(items: Column) -> Column:
    ordered = F.array_sort(items)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    found = linked(spans(docs.select("doc_id", "text")))
    names = F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), F.col("rank") + 1)
    item = F.struct(F.col("start"), F.col("rank"), names.alias("kind"), F.col("end"))
    base = F.col("reported") & F.col("rank").isin(*[RANK[k.name] for k in BASE])
    count = lambda k: F.count_if(F.col("reported") & (F.col("rank") == RANK[k.name])).cast("long")
    per_row = found.groupBy("row", "doc_id").agg(
        count(ASSIGN).alias("n_assign"),
        count(ACCESS).alias("n_access"),
        count(HEX).alias("n_hex"),
        F.collect_list(F.when(base, item)).alias("base"),
        F.collect_list(F.when(F.col("reported"), item)).alias("all"),
        F.count_if(F.col("reported") & ~base).cast("long").alias("n_linked"),
    )
    return per_row.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("all")).alias("spans"),
        "n_linked",
    )


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """DuckDB SQL for ``op11_secret_scan``: the plain patterns, all matches placed, then the length rules."""
    quoted = lambda text: text.replace("'", "''")
    parts = []
    for k in KINDS:
        pat = quoted(k.pattern)
        parts.append(
            f"SELECT doc_id, t, {RANK[k.name]} AS rank, {k.least} AS least, {k.most if k.most is not None else 'NULL'} AS most, "
            f"regexp_extract_all(t, '{pat}', 0) AS ms, regexp_extract_all(t, '{pat}', {k.group}) AS ps, "
            f"string_split_regex(t, '{pat}') AS gs FROM u"
        )
    names = ", ".join(f"({RANK[k.name]}, '{k.name}')" for k in KINDS)
    base = ", ".join(str(RANK[k.name]) for k in BASE)
    joined = "name || ':' || CAST(s AS VARCHAR) || ':' || CAST(en AS VARCHAR)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT DISTINCT doc_id, t FROM d),
m AS ({" UNION ALL ".join(parts)}),
e AS (SELECT doc_id, t, rank, least, most, ms, ps, gs, unnest(range(1, len(ms) + 1)) AS i FROM m),
p AS (SELECT doc_id, t, rank, least, most, i, length(ms[i]) AS len, length(ps[i]) AS chk, length(gs[i]) AS gap FROM e),
q AS (SELECT *, sum(gap + len) OVER (PARTITION BY doc_id, t, rank ORDER BY i ROWS UNBOUNDED PRECEDING) AS en FROM p),
ok AS (SELECT doc_id, t, rank, en - len AS s, en FROM q WHERE chk >= least AND (most IS NULL OR chk <= most)),
sc AS (SELECT *, sum(CASE WHEN rank = {RANK[BREAK.name]} THEN 1 ELSE 0 END) OVER (
         PARTITION BY doc_id, t ORDER BY s, CASE WHEN rank = {RANK[BREAK.name]} THEN 0 ELSE 1 END ROWS UNBOUNDED PRECEDING) AS scope FROM ok),
fl AS (SELECT *, bool_or(rank = {RANK[ACCESS.name]}) OVER (PARTITION BY doc_id, t, scope) AS has_access,
              bool_or(rank IN ({RANK[URL.name]}, {RANK[HOST.name]}, {RANK[USER.name]})) OVER (PARTITION BY doc_id, t, scope) AS has_part FROM sc),
rep AS (SELECT doc_id, t, rank, s, en FROM fl
        WHERE rank IN ({base}) OR (rank = {RANK[AWS_SECRET.name]} AND has_access) OR (rank = {RANK[PASSWORD.name]} AND has_part)),
names AS (SELECT * FROM (VALUES {names}) v(rank, name)),
agg AS (
  SELECT doc_id, t,
    count(*) FILTER (WHERE rank = {RANK[ASSIGN.name]}) AS n_assign,
    count(*) FILTER (WHERE rank = {RANK[ACCESS.name]}) AS n_access,
    count(*) FILTER (WHERE rank = {RANK[HEX.name]}) AS n_hex,
    count(*) FILTER (WHERE rank NOT IN ({base})) AS n_linked,
    string_agg({joined}, ',' ORDER BY s, rank) FILTER (WHERE rank IN ({base})) AS base,
    string_agg({joined}, ',' ORDER BY s, rank) AS spans
  FROM rep JOIN names USING (rank) GROUP BY doc_id, t)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked
FROM d LEFT JOIN agg ON d.doc_id IS NOT DISTINCT FROM agg.doc_id AND d.t = agg.t
"""
