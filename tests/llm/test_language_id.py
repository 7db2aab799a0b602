import duckdb
import pytest
from fixtures import documents, empty, listed, odd_rows, row
from hushmark.llm import language_id as lang
from hushmark.llm.common import table

LETTERS = {"aa": "ala bana cada data", "bb": "ole pole mole tole", "cc": "ii kii sii nii"}


@pytest.fixture(scope="module")
def model(spark):
    rows = [row(i, " ".join(LETTERS[k].split()[(i + j) % 4] for j in range(30)), k) for i, k in enumerate(list(LETTERS) * 10)]
    rows += [row(900, None, "aa"), row(901, "text", None), row(902, "", "bb"), row(903, "x" * 30_000, "cc")]
    return lang.learn(documents(spark, rows))


def test_learned_words(model):
    assert set(model) == set(LETTERS)
    assert {k: set(v.decode().split()) for k, v in model.items()} == {k: set(v.split()) for k, v in LETTERS.items()}


def test_odd_texts(spark, model):
    got = {repr(r.doc_id): r for r in lang.identify(documents(spark), model).collect()}
    assert lang.identify(documents(spark), model).count() == len(odd_rows())
    for i in (100, 101, 102, 103):
        assert (got[str(i)].lang_pred, got[str(i)].score, got[str(i)].rejected) == ("und", 0.0, True)
    assert all(r.lang_pred in {*LETTERS, "und"} and 0 <= r.score <= 1 for r in got.values())
    assert all(r.lang_pred != "und" for k, r in got.items() if k in ("106", "107", "111"))


def test_nothing_learned(spark):
    assert lang.learn(empty(spark)) == {}
    assert {r.lang_pred for r in lang.identify(documents(spark), {}).collect()} == {"und"}
    assert lang.identify(empty(spark), {}).count() == 0
    one = {"aa": b" ala bana "}
    assert {(r.lang_pred, r.score) for r in lang.identify(documents(spark, [row(1, "ala")]), one).collect()} == {("aa", 1.0)}


def test_whole_text_counts(model):
    known = tuple(sorted(model.items()))
    long = "!!! " * 3000 + LETTERS["bb"] * 3 + " " + LETTERS["cc"] * 400
    assert lang.judge(long, known)[0] == "cc"
    assert lang.judge(LETTERS["bb"] * 400 + " " + LETTERS["cc"] * 3, known)[0] == "bb"


def test_filter_keeps_columns(spark, model):
    docs = documents(spark)
    kept = lang.keep_identified(docs, model)
    assert kept.columns == docs.columns
    rejected = [r.rejected for r in lang.identify(docs, model).collect()]
    assert listed(kept) == sorted(repr(tuple(x)) for x, no in zip(docs.collect(), rejected, strict=True) if not no)


def test_training_rows(spark, tiny):
    got = {r.doc_id for r in lang.training_rows(table(spark, tiny, "documents")).collect()}
    import zlib

    assert got and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in got)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = lang.op4_language_id(spark, folder).collect()
    known = dict(duckdb.connect().sql(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    held = [r for r in got if r.held_out]
    assert len(got) == len(known) and len(held) > 200
    assert sum(r.lang_pred == known[r.doc_id] for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in got) / len(got) < 0.01
