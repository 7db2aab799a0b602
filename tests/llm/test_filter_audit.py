"""The filter audit against a plain count over every order, and its SQL."""

import re
from itertools import permutations

import duckdb
from fixtures import documents, empty, row
from hushmark.llm import filter_audit


def plain(docs, labels):
    """Rows (part, order, step, kept, removed, redundant, unique, good_lost, toxic_lost, shapley)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, t, source in docs:
        t = t or ""
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = set()
        if len(ws) < 50:
            fails.add("A")
        if 100 * len(set(ws)) < 65 * len(ws):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        rows.append(("" if source is None else source, fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shap = {c: 0 for c in "ABCDE"}
        made = []
        for order in permutations("ABCDE"):
            gone = set()
            for k, c in enumerate(order):
                removed = [n for n, r in enumerate(mine) if c in r[1] and n not in gone]
                redundant = sum(c in r[1] and n in gone for n, r in enumerate(mine))
                gone |= set(removed)
                shap[c] += len(removed)
                made.append([part, "".join(order), k + 1, len(mine) - len(gone), len(removed), redundant,
                             sum(r[1] == {c} for r in mine), sum(mine[n][2] for n in removed), sum(mine[n][3] for n in removed), c])
        for m in made:
            out[tuple(m[:3])] = (*m[:9], shap[m[9]])
    return sorted(out.values())


def got(spark, docs, labels):
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, source string")
    return sorted(tuple(r) for r in filter_audit.audit(docs, lab).collect())


def test_odd_rows(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    labels = [(0, 1, 0, "x"), (1, 0, 1, "x"), (1, 1, None, "x"), (108, 1, 1, None), (None, 1, 1, None)]
    assert got(spark, docs, labels) == plain(rows, [lab[:3] for lab in labels])


def test_parts_copies_and_symbols(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "a"), (3, text, "b"), (3, text, "b"), (None, text, None), (7, text + " #", "a"), (8, text.upper(), None),
            (9, " ".join(["same"] * 60), "a"), (10, None, "a"), (11, "", None)]
    docs = documents(spark, [(*row(i, t)[:3], s, *row(i, t)[4:]) for i, t, s in rows])
    assert got(spark, docs, [(3, 1, 1, "q")]) == plain(rows, [(3, 1, 1)])
    parts = {r[0] for r in got(spark, docs, [])}
    assert parts == {"a", "b", ""} and len(got(spark, docs, [])) == 3 * 600


def test_transducer():
    assert filter_audit.measure("Ab  c\té ü\n#x") == (5, 5, 1, 12, 1)
    assert filter_audit.measure(None) == (0, 0, 0, 0, 0)
    assert filter_audit.measure("a a a") == (3, 1, 0, 5, 0)


def test_empty(spark):
    assert filter_audit.audit(empty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_sql(spark):
    from test_queries import FOLDER

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.sql(filter_audit.ORACLE)
    mine = filter_audit.op13_filter_audit(spark, FOLDER)
    assert want.columns == mine.columns
    assert sorted(tuple(r) for r in want.fetchall()) == sorted(tuple(r) for r in mine.collect())
