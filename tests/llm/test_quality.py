import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from fixtures import documents, empty, listed, odd_rows, row
from hushmark.llm import quality_classifier as qc
from hushmark.llm import quality_rules as qr
from hypothesis import given, settings
from hypothesis import strategies as st

BLANK = " \t\n\v\f\r"


def plain(text):
    text, w = text or "", []
    for line in [text]:
        word = ""
        for c in line + " ":
            if c in BLANK:
                w += [word] if word else []
                word = ""
            else:
                word += c
    often = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if often[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "a b c d e", "\n", "#x|", " ", "é ", "\x1c", "<>", "\t"]), max_size=60).map(" ".join))
def test_counts(text):
    assert qr.counts(text)[:5] == plain(text)


def test_long_texts_count_alike(monkeypatch):
    text = " ".join(f"w{i % 997} x{i % 13}" for i in range(50_000)) + " end" * 9
    words = text.encode().split()
    assert qr.repeated_words(words) == plain(text)[4]
    assert qr.repeated_words([b"%d" % i for i in range(70_000)]) == 0


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_rules_on_odd_rows(spark):
    docs = documents(spark)
    got = qr.apply_rules(docs, labelled(spark, [(1, 1, 0), (1, 0, 0), (2, 1, 0), (None, 0, 0), (3, None, 1), (4, 7, 0)]))
    rows = got.collect()
    want = [(r[0], *plain(r[1])) for r in odd_rows()]
    assert sorted(repr(tuple(r)[:6]) for r in rows) == sorted(map(repr, want))
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert qr.apply_rules(empty(spark), labelled(spark, [])).count() == 0


def test_without_labels_only_the_fixed_rules(spark):
    got = qr.apply_rules(documents(spark), labelled(spark, [])).collect()
    assert all(r.kept != r.base_failed for r in got)


def test_paths_of_a_small_forest():
    x = np.array([[0.0], [0.1], [0.2], [0.3], [9.0]])
    forest = qr.grow(x, trees=300, leaves=5)
    score = forest.score(x)
    assert score.argmax() == 4 and (0 < score).all() and (score < 1).all()

    def walk(tree, v):
        node, f = 0, forest.feature[tree]
        while f[node] >= 0:
            node = 2 * node + 1 + int(v[f[node]] >= forest.split[tree, node])
        return forest.path[tree, node]

    want = [2 ** (-np.mean([walk(t, v) for t in range(300)]) / forest.usual) for v in x]
    assert np.allclose(score, want)
    assert qr.grow(x[:1]).score(x).tolist() == [0.0] * 5


@pytest.mark.parametrize("size", ["sf0.1"])
def test_rules_against_labels(spark, size):
    folder = f"/root/testdata/{size}"
    kept = {r.doc_id: r.kept for r in qr.op2_quality_rules(spark, folder).collect()}
    labels = duckdb.connect().sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    good = [kept[d] for d, q in labels if q == 1]
    bad = [kept[d] for d, q in labels if q == 0]
    assert sum(good) / len(good) > 0.96 and sum(bad) / len(bad) < 0.1


def test_trees_learn_and_walk(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = qc.boost(x[:2000], y[:2000], trees=30)
    score = trees.score(x)
    assert ((score[2000:] > 0.5) == y[2000:]).mean() > 0.97

    def walk(v):
        total = trees.start
        for t in range(len(trees.feature)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + int(v[trees.feature[t, node]] > trees.split[t, node])
            total += trees.leaf[t, node - trees.feature.shape[1]]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(score[:200], [walk(v) for v in x[:200]])


def test_classifier_on_odd_rows(spark):
    docs = documents(spark)
    labels = labelled(spark, [(i, i % 2, 0) for i in range(40)] + [(1, 0, 0), (None, 1, 1), (2, None, 0), (3, 9, 0), (100, 0, 0)])
    trees = qc.fit(docs, labels)
    got = qc.classify(docs, trees)
    assert got.count() == len(odd_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.collect())
    kept = qc.keep_good(docs, trees)
    assert kept.columns == docs.columns
    assert kept.count() == got.where("predicted = 1").count()
    none = qc.fit(docs, labelled(spark, []))
    assert {r.score for r in qc.classify(docs, none).collect()} == {0.5}
    assert qc.classify(empty(spark), none).count() == 0 and listed(qc.keep_good(empty(spark), none)) == []


def test_sample_is_bounded(spark):
    docs = documents(spark, [row(i, f"text {i}") for i in range(300)])
    trees = qc.fit(docs, labelled(spark, [(i, i % 2, 0) for i in range(300)]), rows=50)
    assert qc.classify(docs, trees).count() == 300


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in qc.op8_quality_classifier(spark, folder).collect()}
    labels = duckdb.connect().sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    held = [(got[d].predicted, q) for d, q in labels if got[d].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert sum(p == q for p, q in held) / len(held) > 0.98
