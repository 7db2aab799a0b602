import hashlib
import re

import pytest
from fixtures import documents, empty, odd_rows, row
from hushmark.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    found = []
    for doc_id, text in docs:
        w, hit, matched = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            k = min(window, len(v))
            for i in range(len(v) - k + 1) if k else ():
                for at in range(len(w) - k + 1):
                    if w[at : at + k] == v[i : i + k]:
                        hit |= set(range(at, at + k))
                        matched.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(matched)).encode()).hexdigest()
        found.append((doc_id, len(w), len(hit), len(matched), digest, bool(hit)))
    return sorted(map(repr, found))


ITEMS = [
    (1, "p q r s t u v w x y z p q r s"),
    (2, "short item"),
    (3, None),
    (4, "...!"),
    (5, "p q r s t u v w x y z p q r s"),
    (6, "the the the the the the the the the the the"),
    (7, "one"),
    (7, "one"),
    (8, "À la carte"),
    (10, "p q r s t u v w x q"),
]


def cases():
    rows = odd_rows()
    rows.append(row(200, "before P-Q r S t u v w x y after p q r s t u v w x y z"))
    rows.append(row(201, "p q r s t u v w x short, item! short item"))
    rows.append(row(202, "the " * 40))
    rows.append(row(203, "à la carte À LA carte"))
    rows.append(row(204, "p q r s t u v w x q r s t u v w x y z p"))
    return rows


def test_brute_force(spark):
    rows = cases()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = d.decontaminate(documents(spark, rows), items).drop("copy")
    assert sorted(map(repr, map(tuple, got.collect()))) == brute([r[:2] for r in rows], ITEMS)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(d, "broadcast_if_small", lambda df, *chars: df)
    rows = cases()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = d.decontaminate(documents(spark, rows), items).drop("copy")
    assert sorted(map(repr, map(tuple, got.collect()))) == brute([r[:2] for r in rows], ITEMS)


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert d.decontaminate(empty(spark), items).count() == 0
    assert not any(r.contaminated for r in d.decontaminate(documents(spark), items).collect())
    assert d.keep_clean(documents(spark), items).count() == len(odd_rows())


def test_keep_clean_keeps_columns_and_odd_rows(spark):
    rows = cases()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, rows)
    kept = d.keep_clean(docs, items)
    dirty = {r.doc_id for r in d.decontaminate(docs, items).collect() if r.contaminated}
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(x) for x in docs.collect() if x.doc_id not in dirty)


def test_same_id_other_text(spark):
    docs = documents(spark, [row(1, "p q r s t u"), row(1, "v w x y z")])
    items = spark.createDataFrame([(1, "p q r s t u v w x y z")], "item_id long, text string")
    assert not any(r.contaminated for r in d.decontaminate(docs, items).collect())


def test_near_matches(spark):
    docs = documents(spark, [row(1, "red fox and blue hen"), row(2, "blue hen saw one red fox"), row(3, "red fox " + "x " * 20 + "blue hen")])
    items = spark.createDataFrame([(1, "red blue hen fox"), (2, "red unicorn")], "item_id long, text string")
    index = d.build_index(docs.select("doc_id", "text"), d.item_words(items))
    got = {(r.doc_id, r.item_id, r.start, r.end) for r in d.near_matches(index, items, 6).collect()}
    assert got == {(1, 1, 0, 4), (2, 1, 0, 5)}


def test_plan_is_native(spark, tiny):
    plan = d.op1_decontamination(spark, tiny)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("window", [3, 5])
def test_other_windows(spark, window):
    rows = cases()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = d.decontaminate(documents(spark, rows), items, window).drop("copy")
    assert sorted(map(repr, map(tuple, got.collect()))) == brute([r[:2] for r in rows], ITEMS, window)


def test_documents_that_begin_within_an_item(spark):
    words = [f"c{i}" for i in range(20)]
    words[12:14] = "rareone", "raretwo"
    items = [(1, " ".join(words)), (2, " ".join(words[:12]))]
    rows = [row(1000 + i, " ".join(w for w in words if not w.startswith("rare"))) for i in range(5)]
    rows += [row(a * 100 + b, " ".join(words[a:b])) for a in range(20) for b in range(a + 1, 21)]
    got = d.decontaminate(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).drop("copy")
    assert sorted(map(repr, map(tuple, got.collect()))) == brute([r[:2] for r in rows], items)
