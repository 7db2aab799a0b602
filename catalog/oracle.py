"""DuckDB SQL for the registered queries.

Written from the rules' plain statement, with patterns in RE2's dialect and without
the shortcuts that the Spark side takes, so that the two can disagree.
"""

from __future__ import annotations

from hushmark.plans import derive
from hushmark.rules import guidelines, labels, review, seeding
from hushmark.rules.pii import AUDIT_NAMES, NAME_BANK, TOKENS

ORACLE: dict[str, str] = {}

# The six redaction patterns as stated, in RE2's (and CPython's) dialect; a street word that
# is stated twice and a tail that cannot match are left out.
_BANK = "|".join(NAME_BANK)
PATTERNS = {
    "name": rf"\b(?:{_BANK})\s+(?:{_BANK})\b",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": (
        r"(?:\b\d{3}[-.]?\d{3}[-.]?\d{4}\b|\(\d{3}\)\s*\d{3}[-.]?\d{4}"
        r"|\+\d{1,3}\s?\d{3}\s?\d{3}\s?\d{4}|\b\d{10}\b"
        r"|(?:Tel|Cel|Cell|Phone|WhatsApp):\s*[\d\s\-\+\(\)]+\b)"
    ),
    "social": (
        r"(?:@[A-Za-z0-9_]+"
        r"|(?:IG|Instagram|Twitter|FB|Facebook|Snap|Snapchat):\s*@?[A-Za-z0-9_.]+)"
    ),
    "address": (
        r"\b\d+\s+[A-Za-z\s]+(?:Street|St|Avenue|Ave|Drive|Dr|Road|Rd|Boulevard|Blvd|Lane|Ln|Way"
        r"|Court|Ct|Plaza|Place|Pl|Calle|Avenida|Av|Privada|Col\.|Colonia)\b[^.]*"
    ),
    "url": r"""https?://[^\s<>"{}|\\^`\[\]]+""",
}
COUNTED = ("name", "email", "phone", "social", "address")
OWN_PATTERN = r"\bth[a-z]+\b"


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def options(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def among(column: str, values) -> str:
    return f"{column} IN (" + ", ".join(text(v) for v in values) + ")"


def draw(n: int, salt: str, *keys: str) -> str:
    parts = ", ".join([*keys, text(salt)])
    return f"(CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 8) AS BIGINT) % {n})"


def pick(values, index: str) -> str:
    return f"({options(values)})[({index}) + 1]"


K = ("conv_id", "turn")


def label(values, salt: str) -> str:
    return pick(values, draw(len(values), salt, *K))


# --- derived tables ------------------------------------------------------------------

MSG = "msg AS (SELECT *, conv_id || ':' || turn AS message_id FROM conversations)"

_PROFILE_INDEX = (
    f"CASE WHEN {draw(10, 'profile_change', *K)} = 0 THEN {draw(3, 'profile2', *K)} "
    f"ELSE {draw(3, 'profile', 'conv_id')} END"
)
ANN = f"""ann AS (SELECT *,
  {label(derive.INTENTS, 'intent')} AS primary_intent,
  {label(derive.TONES, 'tone')} AS message_tone,
  {label(derive.LEVELS, 'safety')} AS safety_level,
  {label(derive.STAGES, 'stage')} AS rapport_stage,
  {label(derive.STATUSES, 'status')} AS customer_status,
  {pick(derive.PROFILES, _PROFILE_INDEX)} AS profile_id,
  {draw(100, 'confidence', *K)} / 100.0::DOUBLE AS confidence,
  turn * 600 + {draw(900, 'delay', *K)} AS seconds,
  concat_ws(' ', text, {label(derive.SNIPPETS, 'snippet')}) AS response
  FROM msg)"""

DIMS = ("primary_intent", "message_tone", "safety_level")
_VALUES = {"primary_intent": derive.INTENTS, "message_tone": derive.TONES, "safety_level": derive.LEVELS}


def relabel(who: str) -> str:
    return ", ".join(
        f"CASE WHEN {draw(100, 'relabel_' + d, *K, who)} < 15 "
        f"THEN {pick(v, draw(len(v), 'second_' + d, *K, who))} ELSE {d} END AS {d}"
        for d, v in _VALUES.items()
    )


REC = f"""rec AS (
  SELECT session, message_id, seq, {relabel("session || '-' || seq")}
  FROM ann, (VALUES ('day1'), ('day2')) s(session), (VALUES (0), (1)) q(seq)
  WHERE {draw(10, 'in_session', *K, 'session')} > 0
    AND (seq = 0 OR {draw(5, 'twice', *K, 'session')} = 0)),
last AS (SELECT session, message_id, primary_intent, message_tone, safety_level FROM rec r
  WHERE NOT EXISTS (SELECT 1 FROM rec o WHERE o.session = r.session
    AND o.message_id = r.message_id AND o.seq > r.seq))"""

_ANNOTATORS = ", ".join(f"('{a}')" for a in derive.ANNOTATORS)
LAB = f"""lab AS (SELECT message_id, annotator, {relabel('annotator')}
  FROM ann, (VALUES {_ANNOTATORS}) a(annotator)
  WHERE {draw(2, 'assigned', *K, 'annotator')} = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY annotator) AS k FROM lab),
wide AS (SELECT a.message_id, a.annotator AS annotator1, b.annotator AS annotator2,
  {', '.join(f'a.{d} AS {d}_1, b.{d} AS {d}_2' for d in DIMS)}
  FROM numbered a JOIN numbered b ON a.message_id = b.message_id AND a.k = 1 AND b.k = 2),
pairs AS ({' UNION ALL '.join(
    f"SELECT message_id, annotator1, annotator2, '{d}' AS dimension, {d}_1 AS label1, "
    f"{d}_2 AS label2 FROM wide WHERE {d}_1 IS NOT NULL AND {d}_2 IS NOT NULL" for d in DIMS)})"""

_PHRASE = pick(derive.PHRASES, draw(len(derive.PHRASES), "phrase", *K))
UTT = f"""utt AS (SELECT * FROM msg UNION ALL SELECT * REPLACE (
  CASE WHEN {draw(2, 'alone', *K)} = 0 THEN {_PHRASE}
  ELSE concat_ws(' ', text, {_PHRASE}) END AS text, message_id || ':more' AS message_id) FROM msg)"""

_INDICATORS = " + ".join(
    f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in seeding.SPANISH_INDICATORS
)
GUESS = f"CASE WHEN {_INDICATORS} >= 2 THEN 'es' ELSE 'en' END"


# a template is two or three of the slots; the phrase of each, and the forms of their values
SLOTS = ("name", "email", "phone", "social", "address")
_PAIRS = [(a, b) for i, a in enumerate(SLOTS) for b in SLOTS[i + 1:]]
_TEMPLATES = _PAIRS + [(a, b, c) for i, a in enumerate(SLOTS) for j, b in enumerate(SLOTS[i + 1:], i + 1) for c in SLOTS[j + 1:]]


def _form(form: str, slot: str) -> str:
    digits = f"translate(md5(concat_ws('|', {', '.join(K)}, '{slot}')), 'abcdef', '012345')"
    out, at, words, rest = [], 1, 0, form
    while rest:
        if rest[0] == "#":
            n = len(rest) - len(rest.lstrip("#"))
            out.append(f"substr({digits}, {at}, {n})")
            at, rest = at + n, rest[n:]
        elif rest.startswith("{word}"):
            out.append(pick(seeding.WORDS, draw(len(seeding.WORDS), f"{slot}-word{words}", *K)))
            words, rest = words + 1, rest[6:]
        else:
            end = min([i for i in (rest.find("#"), rest.find("{word}")) if i >= 0] or [len(rest)])
            out.append(text(rest[:end]))
            rest = rest[end:]
    return "(" + " || ".join(out) + ")"


def _one_of(forms, slot: str) -> str:
    return f"CASE {draw(len(forms), slot, *K)} " + " ".join(
        f"WHEN {i} THEN {_form(f, slot)}" for i, f in enumerate(forms)
    ) + " END"


def _slot_value(slot: str) -> str:
    if slot == "name":
        one, two = (pick(NAME_BANK, draw(len(NAME_BANK), f"name{i}", *K)) for i in (1, 2))
        value = f"{one} || ' ' || {two}"
    elif slot == "address":
        value = f"CASE lang WHEN 'en' THEN {_one_of(seeding.ADDRESS_FORMS['en'], slot)} ELSE {_one_of(seeding.ADDRESS_FORMS['es'], slot)} END"
    else:
        value = _one_of(seeding.FORMS[slot], slot)
    having = ", ".join(str(i) for i, chosen in enumerate(_TEMPLATES) if slot in chosen)
    return f"CASE WHEN tpl_no IN ({having}) THEN {value} END AS v_{slot}"


_CARRIED = ", ".join(
    f"CASE lang WHEN 'en' THEN {text(seeding.CARRIERS['en'][s])} ELSE {text(seeding.CARRIERS['es'][s])} END || v_{s}" for s in SLOTS
)
_FILLED = f"concat_ws('; ', {_CARRIED})"
SEEDED = f"""s1 AS (SELECT *, CASE WHEN text <> '' AND {draw(100, 'hit', *K)} < 25 THEN {GUESS} END AS lang
  FROM msg),
s2 AS (SELECT *, CASE WHEN lang IS NOT NULL THEN {draw(len(_TEMPLATES), 'template', *K)} END AS tpl_no FROM s1),
s3 AS (SELECT *, {', '.join(map(_slot_value, SLOTS))} FROM s2),
seeded AS (SELECT * REPLACE (CASE WHEN tpl_no IS NULL THEN text
    WHEN {draw(2, 'side', *K)} = 0 THEN {_FILLED} || '. ' || text
    ELSE text || ' ' || {_FILLED} END AS text) FROM s3)"""

VALUES = "vals AS (" + " UNION ALL ".join(
    f"SELECT *, '{field}' AS category, v_{slot} AS value FROM {{src}} WHERE v_{slot} IS NOT NULL"
    for slot, field in seeding.TRUTH_FIELDS.items()
) + ")"


def redacted(source: str, column: str = "text", categories=tuple(PATTERNS), counted=COUNTED) -> str:
    """CTEs from ``source`` to ``red``: t0 .. tn, one count per category."""
    steps = [f"r0 AS (SELECT *, {column} AS t0 FROM {source})"]
    for i, c in enumerate(categories):
        p = text(PATTERNS.get(c, OWN_PATTERN))
        steps.append(
            f"r{i + 1} AS (SELECT *, CAST(len(regexp_extract_all(t{i}, {p}, 0, 'i')) AS INTEGER) AS n_{c}, "
            f"regexp_replace(t{i}, {p}, '{TOKENS.get(c, '[TH]')}', 'gi') AS t{i + 1} FROM r{i})"
        )
    n = len(categories)
    total = " + ".join(f"n_{c}" for c in categories if c in counted)
    steps.append(
        f"red AS (SELECT *, CASE WHEN t{n} <> t0 THEN true END AS _anonymized, "
        f"CASE WHEN t{n} <> t0 THEN {total} END AS _pii_removed_count, t{n} AS clean FROM r{n})"
    )
    return ",\n".join(steps)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


ALL_COUNTS = ", ".join(f"n_{c}" for c in PATTERNS)
FLAGS = "_anonymized, _pii_removed_count"
STATS = ", ".join(
    f"CAST(sum(n_{c}) AS BIGINT) AS {c}_removed" for c in COUNTED
) + ", CAST(coalesce(sum(_pii_removed_count), 0) AS BIGINT) AS total_removed"

# --- redaction -----------------------------------------------------------------------

ORACLE["pii_redact_documents"] = (
    with_(redacted("documents")) + f"SELECT doc_id, clean AS text, {ALL_COUNTS}, {FLAGS} FROM red"
)
for _by in ("lang", "source"):
    ORACLE[f"pii_stats_by_{_by}"] = (
        with_(redacted("documents")) + f"SELECT {_by}, {STATS} FROM red GROUP BY {_by}"
    )
ORACLE["pii_redact_own_rule"] = (
    with_(redacted("documents", categories=(*PATTERNS, "the"), counted=(*COUNTED, "the")))
    + "SELECT source, CAST(sum(n_the) AS BIGINT) AS the_removed, " + STATS + " FROM red GROUP BY source"
)
ORACLE["pii_redact_selected"] = (
    with_(redacted("documents", categories=("email", "phone")))
    + "SELECT doc_id, clean AS text, n_email, n_phone, _pii_removed_count FROM red"
)
ORACLE["pii_redact_pages"] = (
    with_(redacted("pages", "html")) + f"SELECT page_id, clean AS html, {ALL_COUNTS}, {FLAGS} FROM red"
)
ORACLE["pii_redact_seeded"] = (
    with_(MSG, SEEDED, redacted("seeded"))
    + f"SELECT message_id, clean AS text, {ALL_COUNTS}, {FLAGS} FROM red"
)
ORACLE["pii_redact_nested"] = (
    with_(MSG, SEEDED, redacted("seeded"))
    + f"SELECT conv_id, message_id, role, clean AS text, {FLAGS} FROM red"
)
_ENTITIES = with_(
        MSG,
        f"""words AS (SELECT message_id, conv_id, turn, i - 1 AS word_no,
  regexp_replace(string_split(text, ' ')[i], '[.,\n]+', '', 'g') AS entity
  FROM msg, range(1, len(string_split(text, ' ')) + 1) g(i))""",
        f"""ment AS (SELECT message_id, entity FROM words
  WHERE length(entity) >= 4 AND {draw(20, 'person', *K, 'word_no')} = 0)""",
        """ents AS (SELECT message_id, count(*) AS n_mentions,
  list(DISTINCT entity ORDER BY entity) AS names FROM ment GROUP BY message_id)""",
        """ordered AS (SELECT message_id, n_mentions, list(name ORDER BY length(name) DESC, name) AS names
  FROM (SELECT message_id, n_mentions, unnest(names) AS name FROM ents)
  GROUP BY message_id, n_mentions)""",
        redacted("msg"),
        """done AS (SELECT red.message_id, t0, n_name, n_email + n_phone + n_social + n_address AS others,
  coalesce(n_mentions, 0) AS mentions, coalesce(len(names), 0) AS kinds,
  CASE WHEN names IS NULL THEN clean ELSE
    list_reduce(list_prepend(clean, names), lambda acc, x: replace(acc, x, '[NAME_REMOVED]')) END AS text
  FROM red LEFT JOIN ordered USING (message_id))""",
    )
ORACLE["entity_list_redact"] = _ENTITIES + """SELECT message_id, text, CAST(n_name + mentions AS INTEGER) AS n_name,
  CASE WHEN text <> t0 THEN true END AS _anonymized,
  CASE WHEN text <> t0 THEN CAST(n_name + others + mentions AS INTEGER) END AS _pii_removed_count
FROM done"""
ORACLE["entity_list_redact_nested"] = _ENTITIES + """SELECT conv_id, message_id, text,
  CASE WHEN text <> t0 THEN CAST(n_name + others + kinds AS INTEGER) END AS _pii_removed_count
FROM (SELECT done.*, msg.conv_id FROM done JOIN msg USING (message_id))"""
LINED = (
    "lined AS (SELECT doc_id, source, concat_ws('\n', text, "
    + pick(derive.LINES, draw(len(derive.LINES), "line", "doc_id"))
    + """) AS text FROM documents),
lines AS (SELECT doc_id, source, CAST(i - 1 AS INTEGER) AS line_no, string_split(text, '\n')[i] AS line
  FROM lined, range(1, len(string_split(text, '\n')) + 1) g(i)),
marked AS (SELECT * FROM lines WHERE contains(line, 'sk-')
  AND NOT regexp_matches(line, 'YOUR_.*_KEY', 's'))"""
)
ORACLE["secret_marker_lines"] = with_(LINED) + "SELECT doc_id, source, line_no, line FROM marked"
ORACLE["secret_marker_counts"] = (
    with_(LINED) + "SELECT source, count(*) AS lines FROM marked GROUP BY source"
)

# --- seeding and audit ---------------------------------------------------------------

ORACLE["pii_seed_messages"] = with_(MSG, SEEDED) + (
    "SELECT message_id, text, lang AS seed_lang, tpl_no AS seed_template, "
    + ", ".join(f"v_{s} AS {f}" for s, f in seeding.TRUTH_FIELDS.items())
    + " FROM seeded"
)
ORACLE["pii_seed_nested"] = with_(MSG, SEEDED) + (
    "SELECT conv_id, message_id, text, " + ", ".join(f"v_{s} AS {f}" for s, f in seeding.TRUTH_FIELDS.items()) + " FROM seeded"
)
ORACLE["message_language"] = (
    f"SELECT lang, {GUESS} AS guess, count(*) AS n FROM documents GROUP BY ALL"
)
ORACLE["seeding_totals"] = with_(MSG, SEEDED) + (
    "SELECT role, count(DISTINCT conv_id) AS conversations, count(*) AS messages, "
    "count(tpl_no) AS messages_seeded, round(count(tpl_no) * 100.0::DOUBLE / count(*), 6) AS percent_seeded, "
    + ", ".join(f"count(DISTINCT v_{s}) AS distinct_{f}" for s, f in seeding.TRUTH_FIELDS.items())
    + " FROM seeded GROUP BY role"
)
ORACLE["seeding_values"] = with_(MSG, SEEDED, VALUES.format(src="seeded")) + (
    "SELECT role, category, value, count(*) AS uses FROM vals GROUP BY ALL"
)
_RECALL = (
    "count(*) AS seeded, count(*) FILTER (NOT contains(clean, value)) AS removed, "
    "round(count(*) FILTER (NOT contains(clean, value)) / count(*)::DOUBLE, 9) AS recall FROM vals GROUP BY ALL"
)
_RECALL_WITH = with_(MSG, SEEDED, redacted("seeded"), VALUES.format(src="red"))
ORACLE["pii_recall"] = _RECALL_WITH + "SELECT category, value, " + _RECALL
ORACLE["pii_recall_by_template"] = (
    _RECALL_WITH + "SELECT lang AS seed_lang, tpl_no AS seed_template, category, " + _RECALL
)


def _found(column: str) -> str:
    named = ", ".join(
        f"CASE WHEN contains(lower({column}), lower({text(n)})) THEN {text(n)} END" for n in AUDIT_NAMES
    )
    scans = ", ".join(
        f"regexp_extract_all({column}, {text(PATTERNS[c])}, 0, 'i') AS {c}s"
        for c in ("email", "phone", "social")
    )
    return f"{scans}, list_filter([{named}], lambda x: x IS NOT NULL) AS names"


_KINDS = ("emails", "phones", "socials", "names")
_ANY = " OR ".join(f"len({k}) > 0" for k in _KINDS)
ORACLE["pii_residual_audit"] = with_(
    MSG, SEEDED, redacted("seeded"),
    "both_texts AS (SELECT role, text, 'before' AS stage FROM seeded "
    "UNION ALL SELECT role, clean, 'after' FROM red)",
    f"scan AS (SELECT *, {_found('text')} FROM both_texts)",
) + (
    f"SELECT stage, role, count(*) AS messages, count(*) FILTER ({_ANY}) AS messages_with_pii, "
    + ", ".join(f"CAST(sum(len({k})) AS BIGINT) AS {k}" for k in _KINDS)
    + " FROM scan GROUP BY ALL"
)
ORACLE["pii_residual_details"] = with_(
    MSG, SEEDED, f"scan AS (SELECT *, {_found('text')} FROM seeded)"
) + (
    "SELECT message_id, "
    + ", ".join(f"array_to_string({k}, '|') AS {k}" for k in _KINDS)
    + f" FROM scan WHERE {_ANY}"
)
DAMAGED = f"""damaged AS (SELECT conv_id, turn, message_id,
  CASE WHEN {draw(50, 'role', *K)} = 0 THEN 'unknown' ELSE role END AS role
  FROM msg WHERE {draw(50, 'lost', *K)} > 0)"""
ORACLE["structure_diff"] = with_(MSG, DAMAGED) + (
    "SELECT conv_id, turn, 'missing_message' AS difference FROM msg m "
    "WHERE NOT EXISTS (SELECT 1 FROM damaged d WHERE d.message_id = m.message_id) "
    "UNION ALL SELECT m.conv_id, m.turn, 'role' FROM msg m JOIN damaged d USING (message_id) "
    "WHERE m.role IS DISTINCT FROM d.role"
)
ORACLE["structure_preserved"] = with_(MSG, SEEDED, redacted("seeded")) + (
    "SELECT count(*) AS differences FROM msg m FULL JOIN red r USING (conv_id, turn) "
    "WHERE m.message_id IS DISTINCT FROM r.message_id OR m.role IS DISTINCT FROM r.role"
)
ORACLE["structure_counts"] = with_(MSG, DAMAGED) + (
    "SELECT conv_id, o AS original_messages, coalesce(r, 0) AS redacted_messages "
    "FROM (SELECT conv_id, count(*) AS o FROM msg GROUP BY 1) "
    "LEFT JOIN (SELECT conv_id, count(*) AS r FROM damaged GROUP BY 1) USING (conv_id) "
    "WHERE o <> coalesce(r, 0)"
)
ORACLE["structure_rows_changed"] = with_(
    MSG, DAMAGED, "o AS (SELECT conv_id, turn, role FROM msg)",
    "d AS (SELECT conv_id, turn, role FROM damaged)",
) + (
    "SELECT *, 'original' AS side, count(*) AS n FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM d) GROUP BY ALL "
    "UNION ALL SELECT *, 'redacted', count(*) FROM (SELECT * FROM d EXCEPT ALL SELECT * FROM o) GROUP BY ALL"
)

# --- corpus shape --------------------------------------------------------------------

ORACLE["flatten_messages"] = with_(MSG) + (
    "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, "
    "message_id, role FROM msg WHERE text <> ''"
)
_LENGTHS = "WHERE conv_id IN (SELECT conv_id FROM msg GROUP BY 1 HAVING count(*) BETWEEN 3 AND 50)"
ORACLE["conversation_length_filter"] = (
    with_(MSG) + f"SELECT conv_id, turn, message_id FROM msg {_LENGTHS}"
)
ORACLE["conversation_length_filter_nested"] = with_(MSG) + (
    f"SELECT conv_id, count(*) AS n_messages FROM msg {_LENGTHS} GROUP BY 1"
)
ORACLE["label_tool_tasks"] = with_(MSG) + (
    "SELECT conv_id AS conversation_id, count(*) AS n_messages, "
    "array_to_string(list(role ORDER BY turn)[1:2], '|') AS first_roles FROM msg GROUP BY 1"
)
ORACLE["run_record"] = (
    "SELECT '1.0' AS version, 'completed' AS status, count(DISTINCT source) AS files_processed, "
    "count(*) AS conversations FROM documents"
)
EVENT_DOCS = f"""docs AS (SELECT event_id, CAST(CASE {draw(4, 'shape', 'event_id')}
  WHEN 0 THEN props
  WHEN 1 THEN '{{"kind":"' || event_type || '","props":' || props || '}}'
  WHEN 2 THEN '{{"items":[' || props || ',' || props || '],"kind":null}}'
  ELSE '[' || props || ']' END AS JSON) AS j FROM events)"""
_KIND = """CASE json_type({0}) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
  WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'bool' WHEN 'DOUBLE' THEN 'float'
  WHEN 'NULL' THEN 'null' ELSE 'int' END"""
MEMBERS = f"""mem AS (
  SELECT event_id, k AS key, json_extract(j, '$."' || k || '"') AS v
  FROM (SELECT event_id, j, unnest(json_keys(j)) AS k FROM docs WHERE json_type(j) = 'OBJECT')
  UNION ALL SELECT event_id, '$', j FROM docs WHERE json_type(j) <> 'OBJECT'),
shaped AS (SELECT *, {_KIND.format('v')} AS kind,
  CASE WHEN json_type(v) = 'ARRAY' THEN CAST(json_array_length(v) AS INTEGER) END AS length,
  CASE WHEN json_type(v) = 'ARRAY' THEN json_extract(v, '$[0]') END AS first FROM mem)"""
_KEY_PROFILE = (
    "SELECT key, kind, CASE WHEN first IS NOT NULL THEN "
    + _KIND.format("first")
    + " END AS first_kind, count(*) AS n, min(length) AS min_length, max(length) AS max_length "
    "FROM shaped GROUP BY ALL"
)
ORACLE["json_root_profile"] = with_(EVENT_DOCS) + (
    f"SELECT {_KIND.format('j')} AS root_kind, count(*) AS n FROM docs GROUP BY 1"
)
ORACLE["json_key_profile"] = with_(EVENT_DOCS, MEMBERS) + _KEY_PROFILE
ORACLE["json_inner_keys"] = with_(EVENT_DOCS, MEMBERS) + (
    "SELECT key, inner_key, count(*) AS n FROM (SELECT key, unnest(json_keys("
    "CASE WHEN kind = 'object' THEN v ELSE first END)) AS inner_key FROM shaped "
    "WHERE kind = 'object' OR first IS NOT NULL) GROUP BY ALL"
)
ORACLE["json_shape_profile"] = (
    with_("docs AS (SELECT event_id, CAST(props AS JSON) AS j FROM events)", MEMBERS) + _KEY_PROFILE
)
ORACLE["json_samples"] = with_(EVENT_DOCS, MEMBERS) + (
    "SELECT event_id, key, replace(CAST(v AS VARCHAR), ' ', '') AS value, CAST(k AS INTEGER) AS sample FROM "
    "(SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_id) AS k FROM mem) WHERE k <= 2"
)

# --- labels --------------------------------------------------------------------------


def long_labels(source: str, dimensions, keep: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}'{d}' AS dimension, {d} AS label FROM {source}" for d in dimensions
    )


DIST = f"""dist AS (SELECT dimension, label, count(*) AS n,
  count(*) / (sum(count(*)) OVER (PARTITION BY dimension))::DOUBLE AS share
  FROM ({long_labels('ann', labels.LABEL_DIMENSIONS)}) WHERE label IS NOT NULL GROUP BY 1, 2)"""
DIST_ALL = f"""dist_all AS (SELECT dimension, label, count(*) AS n,
  count(*) / (SELECT count(*) FROM ann)::DOUBLE AS share
  FROM ({long_labels('ann', DIMS)}) WHERE label IS NOT NULL GROUP BY 1, 2)"""
ORACLE["label_distribution"] = (
    with_(MSG, ANN, DIST) + "SELECT dimension, label, n, round(share, 9) AS share FROM dist"
)
ORACLE["label_distribution_all"] = (
    with_(MSG, ANN, DIST_ALL) + "SELECT dimension, label, n, round(share, 9) AS share FROM dist_all"
)
_IN_DOMAIN = " OR ".join(
    f"(dimension = '{d}' AND {among('label', v)})" for d, v in labels.TAXONOMY.items()
)
ORACLE["label_domain_violations"] = with_(MSG, ANN) + (
    "SELECT message_id, dimension, label FROM ("
    + long_labels("ann", labels.TAXONOMY, "message_id, ")
    + f") WHERE label IS NOT NULL AND NOT ({_IN_DOMAIN})"
)
CONFLICTS = """conf AS (
  SELECT message_id, 'negative_feedback_low_safety' AS rule FROM ann
  WHERE primary_intent = 'NEGATIVE_FEEDBACK' AND safety_level IN ('LEVEL_0_SAFE', 'LEVEL_1_FLIRT_SAFE')
  UNION ALL SELECT message_id, 'transactional_in_deep_emotion' FROM ann
  WHERE primary_intent = 'TRANSACTIONAL_INQUIRY' AND rapport_stage = 'DEEP_EMOTION'
  UNION ALL SELECT message_id, 'inappropriate_with_high_rapport' FROM ann
  WHERE safety_level = 'LEVEL_3_INAPPROPRIATE' AND rapport_stage IN ('HIGH_INTENT', 'DEEP_EMOTION'))"""
ORACLE["label_conflicts"] = with_(MSG, ANN, CONFLICTS) + "SELECT message_id, rule FROM conf"
ORACLE["label_conflict_counts"] = (
    with_(MSG, ANN, CONFLICTS) + "SELECT rule, count(*) AS n FROM conf GROUP BY rule"
)
ORACLE["mixed_profiles"] = with_(MSG, ANN) + (
    "SELECT conv_id, count(DISTINCT profile_id) AS profiles FROM ann GROUP BY 1 HAVING profiles > 1"
)

# --- the given labels ----------------------------------------------------------------

GIVEN = """given AS (SELECT doc_id, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic, lang
  FROM labels JOIN documents USING (doc_id)),
long_given AS (SELECT doc_id, 'quality' AS dimension, quality AS label FROM given
  UNION ALL SELECT doc_id, 'toxic', toxic FROM given),
shares AS (SELECT dimension, label, count(*) AS n, count(*) / (sum(count(*)) OVER (PARTITION BY dimension))::DOUBLE AS share
  FROM long_given WHERE label IS NOT NULL GROUP BY 1, 2)"""
ORACLE["given_label_distribution"] = (
    with_(GIVEN) + "SELECT dimension, label, n, round(share, 9) AS share FROM shares"
)
ORACLE["given_label_domain"] = with_(GIVEN) + (
    "SELECT doc_id, dimension, label, 'binary' AS \"check\" FROM long_given WHERE label NOT IN ('0', '1') "
    "UNION ALL SELECT doc_id, dimension, label, 'good' FROM long_given WHERE dimension = 'quality' AND label <> '1'"
)
ORACLE["given_label_balance"] = with_(GIVEN) + (
    "SELECT 'largest_share_' || dimension AS gate, round(max(share), 9) AS value, 0.4::DOUBLE AS threshold, "
    "max(share) <= 0.4 AS ok FROM shares GROUP BY dimension"
)
ORACLE["given_label_confusion"] = (
    with_(GIVEN) + "SELECT lang, quality, toxic, count(*) AS n FROM given GROUP BY ALL"
)
ORACLE["annotation_records"] = with_(MSG, ANN) + (
    f"SELECT message_id, CASE WHEN {draw(4, 'no_text', *K)} > 0 THEN text ELSE 'N/A' END AS text, primary_intent, "
    f"message_tone, safety_level, confidence, CASE WHEN {draw(4, 'no_response', *K)} > 0 THEN response ELSE '' END AS response FROM ann"
)

# --- state machines ------------------------------------------------------------------


def steps(source: str, group: str, state: str, order: str) -> str:
    return (
        f"steps AS (SELECT *, {state} AS cur, lead({state}) OVER w AS nxt, "
        f"row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY {group}) AS n_group, "
        f"{'lead(seconds) OVER w - seconds' if source == 'ann' else 'NULL'} AS waited "
        f"FROM {source} WINDOW w AS (PARTITION BY {group} ORDER BY {order}))"
    )


def moves(edges) -> str:
    pairs = [(a, b) for a, targets in edges.items() for b in targets]
    return "edges(a, b) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in pairs) + ")"


def invalid(group: str, extra: str = "") -> str:
    return (
        f"SELECT {group}, position, coalesce(cur, '<null>') || ' → ' || coalesce(nxt, '<null>') "
        "AS transition FROM steps WHERE position + 1 < n_group AND NOT EXISTS "
        f"(SELECT 1 FROM edges WHERE a = cur AND b = nxt{extra})"
    )


_STEPS = steps("ann", "conv_id", "rapport_stage", "turn")
ORACLE["stage_pairs"] = with_(MSG, ANN, _STEPS) + (
    "SELECT conv_id, position, cur AS rapport_stage, nxt AS next_rapport_stage FROM steps "
    "WHERE position + 1 < n_group"
)
_INVALID = with_(MSG, ANN, _STEPS, moves(labels.STAGE_EDGES)) + invalid("conv_id")
ORACLE["stage_invalid_transitions"] = _INVALID
ORACLE["stage_invalid_transitions_guideline"] = (
    with_(MSG, ANN, _STEPS, moves(labels.GUIDELINE_STAGE_EDGES)) + invalid("conv_id")
)
ORACLE["stage_invalid_transitions_allow_self"] = _INVALID + " AND (cur = nxt) IS NOT TRUE"
ORACLE["stage_invalid_transitions_gap"] = with_(
    MSG, ANN, steps("ann", "conv_id", "rapport_stage", "seconds, turn"),
    moves(labels.GUIDELINE_STAGE_EDGES),
) + invalid("conv_id", " AND (NOT (a = 'CLOSING' AND b = 'ICE_BREAKER') OR waited >= 900)")
HISTORY = f"""history AS (SELECT user_id, ts, event_id AS seq,
  {pick((None, 'MX', 'ES', 'US'), draw(4, 'country', 'event_id'))} AS user_country,
  {pick((None, None, 'teacher', 'driver', 'nurse'), draw(5, 'job', 'event_id'))} AS user_occupation,
  {pick(derive.STATUSES, draw(5, 'status', 'event_id'))} AS customer_status FROM events)"""
ORACLE["status_invalid_transitions"] = with_(
    HISTORY, steps("history", "user_id", "customer_status", "ts, seq"), moves(labels.STATUS_EDGES)
) + invalid("user_id")
ORACLE["first_invalid_transitions"] = _INVALID + " ORDER BY conv_id, position LIMIT 5"

# --- agreement -----------------------------------------------------------------------

ORACLE["latest_annotation"] = with_(MSG, ANN, REC) + "SELECT * FROM last"
ORACLE["shared_messages"] = with_(MSG, ANN, REC) + (
    "SELECT message_id FROM rec WHERE session = 'day1' INTERSECT "
    "SELECT message_id FROM rec WHERE session = 'day2'"
)
BOTH = "both_days AS (" + " UNION ALL ".join(
    f"SELECT a.message_id, '{d}' AS dimension, a.{d} AS label1, b.{d} AS label2 "
    f"FROM last a JOIN last b ON a.message_id = b.message_id AND a.session = 'day1' "
    f"AND b.session = 'day2' WHERE a.{d} IS NOT NULL AND b.{d} IS NOT NULL"
    for d in DIMS
) + """),
agree AS (SELECT coalesce(dimension, 'overall') AS dimension,
  count(*) FILTER (label1 = label2) AS matches, count(*) AS total,
  count(*) FILTER (label1 = label2) / count(*)::DOUBLE AS score
  FROM both_days GROUP BY ROLLUP (dimension))"""
ORACLE["agreement_by_dimension"] = with_(MSG, ANN, REC, BOTH) + (
    "SELECT dimension, matches, total, round(score, 9) AS score, score >= 0.9 AS approved FROM agree"
)
ORACLE["disagreements"] = with_(MSG, ANN, REC, BOTH) + (
    "SELECT message_id, dimension, label1, label2, text FROM both_days "
    "LEFT JOIN msg USING (message_id) WHERE label1 <> label2"
)
ORACLE["calibration_report"] = with_(MSG, ANN, REC, BOTH, """
  listed AS (SELECT message_id, string_agg(dimension || ': ' || label1 || ' → ' || label2, '; '
    ORDER BY dimension || ': ' || label1 || ' → ' || label2) AS changes
    FROM both_days WHERE label1 <> label2 GROUP BY 1)""") + """
SELECT section, item, round(CAST(value AS DOUBLE), 9) AS value, text FROM (
  SELECT 'summary' AS section, 'evaluated' AS item,
    CAST((SELECT count(DISTINCT message_id) FROM rec WHERE session = 'day1') AS DOUBLE) AS value,
    NULL AS text
  UNION ALL SELECT 'agreement', dimension, score, CASE WHEN score >= 0.9 THEN 'pass' ELSE 'fail' END FROM agree
  UNION ALL SELECT 'summary', 'verdict', score,
    CASE WHEN score >= 0.9 THEN 'approved' ELSE 'needs_refinement' END FROM agree WHERE dimension = 'overall'
  UNION ALL SELECT 'summary', 'inconsistent_messages', (SELECT count(*) FROM listed), NULL
  UNION ALL SELECT * FROM (SELECT 'cases', message_id, NULL, changes FROM listed ORDER BY message_id LIMIT 5))"""
BANK = """bank AS (SELECT s.session, message_id AS id,
  row_number() OVER (PARTITION BY s.session ORDER BY md5('bank|' || message_id), message_id) - 1 AS position
  FROM msg, (VALUES ('day1'), ('day2')) s(session))"""
ORACLE["calibration_sessions"] = with_(MSG, BANK) + "SELECT session, position, id FROM bank"
_WORDS = ", ".join(
    f"CAST(sum(CAST('0x' || substr(md5(position || '|' || id), {8 * k + 1}, 8) AS BIGINT)) AS VARCHAR)"
    for k in range(4)
)
_FINGERPRINT = (
    f"SELECT session, count(*) AS items, md5(concat_ws(':', CAST(count(*) AS VARCHAR), {_WORDS})) AS fingerprint "
)
ORACLE["session_fingerprint"] = with_(MSG) + (
    _FINGERPRINT
    + "FROM (SELECT conv_id AS session, turn AS position, message_id AS id FROM msg) GROUP BY session"
)
ORACLE["bank_fingerprint"] = with_(MSG, BANK) + _FINGERPRINT + "FROM bank GROUP BY session"
KAPPA = """cells AS (SELECT dimension, annotator1, annotator2, label1, label2, count(*) AS n
  FROM pairs GROUP BY ALL),
totals AS (SELECT dimension, annotator1, annotator2, CAST(sum(n) AS BIGINT) AS samples,
  sum(CASE WHEN label1 = label2 THEN n ELSE 0 END) / sum(n)::DOUBLE AS observed
  FROM cells GROUP BY ALL),
m1 AS (SELECT dimension, annotator1, annotator2, label1 AS label, sum(n)::DOUBLE AS c FROM cells GROUP BY ALL),
m2 AS (SELECT dimension, annotator1, annotator2, label2 AS label, sum(n)::DOUBLE AS c FROM cells GROUP BY ALL),
chance AS (SELECT dimension, annotator1, annotator2, sum(m1.c * m2.c) AS s
  FROM m1 JOIN m2 USING (dimension, annotator1, annotator2, label) GROUP BY ALL),
kap AS (SELECT dimension, annotator1, annotator2, samples, observed,
  coalesce(s, 0) / (samples::DOUBLE * samples) AS expected,
  CASE WHEN coalesce(s, 0) / (samples::DOUBLE * samples) < 0.9999999999 THEN
    (observed - coalesce(s, 0) / (samples::DOUBLE * samples))
    / (1 - coalesce(s, 0) / (samples::DOUBLE * samples)) END AS kappa
  FROM totals LEFT JOIN chance USING (dimension, annotator1, annotator2))"""
ORACLE["kappa_by_pair"] = with_(MSG, ANN, LAB, KAPPA) + (
    "SELECT dimension, annotator1, annotator2, samples, round(observed, 9) AS observed, "
    "round(expected, 9) AS expected, round(kappa, 9) AS kappa FROM kap"
)
ORACLE["kappa_summary"] = with_(MSG, ANN, LAB, KAPPA) + (
    "SELECT dimension, round(avg(kappa), 9) AS mean_kappa, round(min(kappa), 9) AS min_kappa, "
    "CAST(sum(samples) AS BIGINT) AS samples, count(*) AS pairs FROM kap GROUP BY dimension"
)
ORACLE["confusion_matrix"] = with_(MSG, ANN, LAB) + (
    "SELECT dimension, label1, label2, count(*) AS n FROM pairs GROUP BY ALL"
)

# --- review --------------------------------------------------------------------------


def when(condition: str, code: str, detail: str = "NULL") -> str:
    return f"CASE WHEN {condition} THEN {{'code': '{code}', 'detail': CAST({detail} AS DOUBLE)}} END"


_SENTENCES = "len(string_split_regex(response, '[.!?]+'))"
_EMOJI = r"len(regexp_extract_all(response, '[\x{1F300}-\x{1FAF6}]'))"
_QUESTIONS = "(length(response) - length(replace(response, '?', '')))"
LOW = [when("coalesce(confidence, 1) < 0.8", "low_confidence", "confidence")]
CONSISTENCY = [
    when("primary_intent = 'NEGATIVE_FEEDBACK' AND message_tone = 'FRIENDLY'",
         "inconsistent:negative_feedback_friendly"),
    when("primary_intent = 'COMPLIMENT' AND message_tone = 'FRUSTRATED'",
         "inconsistent:compliment_frustrated"),
    when("safety_level = 'LEVEL_3_INAPPROPRIATE' AND message_tone IN ('FRIENDLY', 'ENGAGED')",
         "inconsistent:inappropriate_positive_tone"),
    when("primary_intent = 'TRANSACTIONAL_INQUIRY' AND coalesce(confidence, 1) < 0.7",
         "low_confidence_transactional", "confidence"),
]
RESPONSE = [
    when(f"{_SENTENCES} > 3", "response_too_long", _SENTENCES),
    when(f"{_EMOJI} > 2", "too_many_emoji", _EMOJI),
    *[
        when(f"regexp_matches(lower(response), {text(p.removeprefix('(?U)'))})", code)
        for code, p in review.WORDING_RULES.items()
    ],
    when(f"ends_with(response, '?') AND {_QUESTIONS} > 1", "too_many_questions", _QUESTIONS),
]
LATE = [
    when("safety_level IN ('LEVEL_2_BORDERLINE', 'LEVEL_3_INAPPROPRIATE')", "safety_review"),
    when("primary_intent IN ('HESITATION_OR_OBJECTION', 'NEGATIVE_FEEDBACK')", "sensitive_intent"),
]


def reviewed(*groups) -> str:
    items = ",\n  ".join(item for group in groups for item in group)
    return f"rev AS (SELECT *, list_filter([{items}], lambda x: x IS NOT NULL) AS reasons FROM ann)"


REV = reviewed(LOW, CONSISTENCY, RESPONSE, LATE)
_CODES = "array_to_string(list_transform(reasons, lambda x: x.code), '|')"
_RANKED = f"SELECT message_id, CAST(len(reasons) AS INTEGER) AS n_reasons, {_CODES} AS codes FROM rev WHERE len(reasons) > 0"
ORACLE["response_quality"] = with_(MSG, ANN, reviewed(RESPONSE)) + (
    f"SELECT message_id, {_CODES} AS codes, coalesce(list_sum(list_transform(reasons, "
    "lambda x: coalesce(x.detail, 0.0::DOUBLE))), 0.0::DOUBLE) AS details FROM rev"
)
ORACLE["annotation_consistency"] = with_(MSG, ANN, reviewed(CONSISTENCY)) + (
    f"SELECT message_id, {_CODES} AS codes FROM rev WHERE len(reasons) > 0"
)
ORACLE["review_candidates"] = with_(MSG, ANN, REV) + _RANKED
ORACLE["review_top20"] = with_(MSG, ANN, REV) + _RANKED + " ORDER BY n_reasons DESC, message_id LIMIT 20"
EXAMPLES = """best AS (SELECT * FROM rev WHERE len(reasons) > 0 ORDER BY len(reasons) DESC, message_id LIMIT 20),
each_reason AS (SELECT message_id, len(reasons) AS n, i, reasons[i].code AS code,
  split_part(reasons[i].code, ':', 1) AS issue FROM best, range(1, 20) g(i) WHERE i <= len(reasons)),
examples AS (SELECT *, row_number() OVER (PARTITION BY issue ORDER BY n DESC, message_id, i) AS k
  FROM each_reason)"""
ORACLE["review_examples_by_issue"] = with_(MSG, ANN, REV, EXAMPLES) + (
    "SELECT issue, CAST(k AS INTEGER) AS rank, message_id, code FROM examples WHERE k <= 3"
)
ORACLE["review_rate"] = with_(MSG, ANN, REV) + (
    "SELECT count(*) AS total, count(*) FILTER (len(reasons) > 0) AS to_review, "
    "round(count(*) FILTER (len(reasons) > 0) / count(*)::DOUBLE, 9) AS rate FROM rev"
)
HISTOGRAM = """hist AS (SELECT split_part(r.code, ':', 1) AS issue, count(*) AS n
  FROM (SELECT unnest(reasons) AS r FROM rev) GROUP BY 1)"""
ORACLE["review_issue_histogram"] = with_(MSG, ANN, REV, HISTOGRAM) + "SELECT issue, n FROM hist"
ANOMALIES = """base AS (SELECT count(*) FILTER (primary_intent = 'OTHER') / count(*)::DOUBLE AS other,
  count(DISTINCT primary_intent)::DOUBLE AS intents,
  count(*) FILTER (safety_level = 'LEVEL_0_SAFE') / count(*)::DOUBLE AS safe FROM ann),
anom AS (SELECT 'other_share_high' AS anomaly, other AS value, 0.05::DOUBLE AS threshold, other > 0.05 AS fires FROM base
  UNION ALL SELECT 'few_intents', intents, 5.0::DOUBLE, intents < 5 FROM base
  UNION ALL SELECT 'safe_share_high', safe, 0.95::DOUBLE, safe > 0.95 FROM base)"""
ORACLE["distribution_anomalies"] = with_(MSG, ANN, ANOMALIES) + (
    "SELECT anomaly, round(value, 9) AS value, threshold, fires FROM anom"
)
RATE = "rate AS (SELECT count(*) FILTER (len(reasons) > 0) / count(*)::DOUBLE AS rate FROM rev)"
ORACLE["quality_gates"] = with_(MSG, ANN, REV, REC, BOTH, RATE) + """
SELECT gate, round(value, 9) AS value, threshold::DOUBLE AS threshold, ok FROM (
  SELECT 'other_share' AS gate, avg(CAST(primary_intent IS NOT DISTINCT FROM 'OTHER' AS DOUBLE)) AS value,
    0.05 AS threshold, value < 0.05 AS ok FROM ann
  UNION ALL SELECT 'risk_share', avg(CAST(safety_level IS NOT NULL AND safety_level <> 'LEVEL_0_SAFE' AS DOUBLE)) AS v,
    0.05, v >= 0.05 FROM ann
  UNION ALL SELECT 'level3_examples', CAST(count(*) FILTER (safety_level = 'LEVEL_3_INAPPROPRIATE') AS DOUBLE) AS v,
    10.0, v >= 10 FROM ann
  UNION ALL SELECT 'largest_share_' || dimension, max(share) AS v, 0.4, v <= 0.4
    FROM (SELECT dimension, label, count(*) / (sum(count(*)) OVER (PARTITION BY dimension))::DOUBLE AS share
      FROM (""" + long_labels("ann", DIMS) + """) WHERE label IS NOT NULL GROUP BY 1, 2) GROUP BY dimension
  UNION ALL SELECT 'review_rate', rate, 0.2, rate < 0.2 FROM rate
  UNION ALL SELECT 'calibration_agreement', score, 0.9, score >= 0.9 FROM agree WHERE dimension = 'overall')"""
ADVICE = """advice AS (
  SELECT 1 AS rank, 'refine_annotation_prompt' AS advice, rate AS value FROM rate WHERE rate > 0.2
  UNION ALL SELECT 2, 'split_other_category', value FROM anom WHERE anomaly = 'other_share_high' AND fires
  UNION ALL SELECT 3, 'check_safety_labels', value FROM anom WHERE anomaly = 'safe_share_high' AND fires)"""
ORACLE["recommendations"] = with_(MSG, ANN, REV, RATE, ANOMALIES, ADVICE) + (
    "SELECT CAST(rank AS INTEGER) AS rank, advice, round(value, 9) AS value FROM advice"
)
STATS_ROWS = """SELECT 'summary' AS section, 'total_messages' AS item, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM rev
  UNION ALL SELECT 'summary', 'messages_needing_review', count(*) FILTER (len(reasons) > 0), NULL FROM rev
  UNION ALL SELECT 'summary', 'review_rate', rate, NULL FROM rate
  UNION ALL SELECT 'anomalies', anomaly, value, NULL FROM anom WHERE fires
  UNION ALL SELECT 'distribution:' || dimension, label, share,
    repeat('█', CAST(floor(share * 20) AS BIGINT)) || ' ' || printf('%.1f%%', round_even(share * 100, 1)) FROM dist_all"""
ORACLE["quick_stats"] = with_(MSG, ANN, REV, RATE, ANOMALIES, DIST_ALL) + (
    f"SELECT section, item, round(CAST(value AS DOUBLE), 9) AS value, text FROM ({STATS_ROWS})"
)
ORACLE["review_report"] = with_(
    MSG, ANN, REV, RATE, ANOMALIES, DIST_ALL, HISTOGRAM, EXAMPLES, ADVICE
) + f"""SELECT section, item, round(CAST(value AS DOUBLE), 9) AS value, text FROM ({STATS_ROWS}
  UNION ALL SELECT 'issues', issue, n, NULL FROM hist
  UNION ALL SELECT 'examples:' || issue, message_id, k, concat_ws(' | ', primary_intent, message_tone, safety_level,
    {_CODES}, text, response) FROM examples JOIN rev USING (message_id) WHERE k <= 3
  UNION ALL SELECT 'recommendations', advice, value, NULL FROM advice)"""
ORACLE["label_report"] = with_(MSG, ANN, DIST, CONFLICTS, _STEPS, moves(labels.STAGE_EDGES)) + (
    "SELECT section, item, round(CAST(value AS DOUBLE), 9) AS value, text FROM ("
    "SELECT 'distribution:' || dimension AS section, label AS item, share AS value, "
    "printf('%.1f%%', round_even(share * 100, 1)) AS text FROM dist "
    "UNION ALL SELECT 'conflicts', rule, count(*), NULL FROM conf GROUP BY rule "
    f"UNION ALL SELECT 'transitions', 'invalid', count(*), NULL FROM ({invalid('conv_id')}) "
    "UNION ALL SELECT 'transition_examples', conv_id || ':' || position, NULL, transition FROM "
    f"(SELECT * FROM ({invalid('conv_id')}) ORDER BY conv_id, position LIMIT 5))"
)

ORACLE["correction_export"] = with_(MSG, ANN, REV) + (
    "SELECT message_id, text, primary_intent, message_tone, safety_level, confidence, "
    f"response AS llm_response, {_CODES} AS issues, "
    + ", ".join(f"CAST(NULL AS VARCHAR) AS human_{c}" for c in review.CORRECTION_FIELDS)
    + " FROM rev WHERE len(reasons) > 0"
)

# --- guideline rules -----------------------------------------------------------------


def words(column: str, values) -> str:
    """Whole words by what is not a letter, digit or underscore around them."""
    return f"regexp_matches({column}, {text('(?:^|[^\\pL\\pN_])(?:' + '|'.join(values) + ')(?:$|[^\\pL\\pN_])')}, 'i')"


ORACLE["safety_keyword_level"] = with_(MSG, UTT) + (
    f"SELECT message_id, CASE WHEN {words('text', guidelines.LEVEL2_WORDS)} "
    "THEN 'LEVEL_2_BORDERLINE' ELSE 'LEVEL_0_SAFE' END AS keyword_level FROM utt"
)
ORACLE["heuristic_intent"] = with_(MSG, UTT) + (
    "SELECT message_id, CASE "
    + " ".join(f"WHEN {words('text', v)} THEN '{k}'" for k, v in guidelines.INTENT_WORDS.items())
    + " END AS heuristic_intent FROM utt"
)
ORACLE["short_replies"] = with_(MSG, UTT) + (
    "SELECT message_id, 'DISMISSIVE' AS suggested FROM utt "
    "WHERE lower(regexp_replace(text, '^[\\s.!…]+|[\\s.!…]+$', '', 'g')) IN ('ok', 'ya')"
)
_OPENING = "^[\\s¡]*(?:" + "|".join(guidelines.GREETING_WORDS) + ")(?:$|[^\\pL\\pN_])"
ORACLE["repeated_greetings"] = with_(
    MSG, UTT, f"greet AS (SELECT * FROM utt WHERE regexp_matches(text, {text(_OPENING)}, 'i'))"
) + (
    "SELECT message_id, 'SMALL_TALK' AS suggested FROM greet g "
    "WHERE EXISTS (SELECT 1 FROM greet e WHERE e.conv_id = g.conv_id AND (e.turn, e.message_id) < (g.turn, g.message_id))"
)
ORACLE["safety_escalation"] = with_(
    MSG, ANN, "flirt AS (SELECT * FROM ann WHERE safety_level = 'LEVEL_1_FLIRT_SAFE')"
) + (
    "SELECT f.message_id, count(*) AS recent FROM flirt f JOIN flirt o ON o.conv_id = f.conv_id "
    "AND o.seconds BETWEEN f.seconds - 1800 AND f.seconds GROUP BY 1 HAVING count(*) >= 2"
)
ATTRIBUTES = "attrs AS (SELECT user_id, " + ", ".join(
    f"arg_max({a}, (ts, seq)) FILTER ({a} IS NOT NULL) AS {a}"
    for a in ("user_country", "user_occupation", "customer_status")
) + " FROM history GROUP BY user_id)"
ORACLE["user_attributes"] = with_(HISTORY, ATTRIBUTES) + (
    "SELECT user_id, user_country, user_occupation, customer_status FROM attrs"
)
_OFFER = "event_type IN ('view', 'click')"
ACTIVITY = f"""act AS (SELECT user_id, count(*) AS interactions, count(*) FILTER ({_OFFER}) AS offers,
  count(*) FILTER (event_type = 'purchase') AS positive_answers,
  count(*) FILTER (event_type = 'error') AS soft_rejections,
  CAST(date_diff('day', CAST(max(ts) FILTER ({_OFFER}) AS DATE), CAST(max(ts) AS DATE)) AS INTEGER)
    AS days_since_offer
  FROM events GROUP BY user_id),
activity AS (SELECT act.*, customer_status AS status FROM act JOIN attrs USING (user_id))"""
ORACLE["lead_activity"] = with_(HISTORY, ATTRIBUTES, ACTIVITY) + "SELECT * FROM activity"
ORACLE["exhausted_leads"] = with_(HISTORY, ATTRIBUTES, ACTIVITY) + (
    "SELECT user_id, interactions FROM activity WHERE status = 'LEAD_QUALIFIED' AND offers >= 3 "
    "AND positive_answers = 0 AND interactions > 20 AND (days_since_offer > 7 OR soft_rejections >= 2)"
)
ORACLE["vocabulary_topk"] = (
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \\t\\n\\r\\f\\x0B]+')) AS word "
    "FROM documents) WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 10000"
)
