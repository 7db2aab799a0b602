"""SQL of the registered queries, and the pipeline against plain Python."""

import re
import zlib

import __spark_entry__
import corpus_pipeline
import duckdb
import pytest
from fixtures import listed
from hushmark.llm import common, language_id, packing, quality_classifier
from hushmark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert listed(got.select(*columns)) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


def test_pipeline(spark):
    from test_decontamination import brute
    from test_simhash import groups, plain

    docs = common.table(spark, FOLDER, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = language_id.learn(language_id.training_rows(docs))
    stay = {i for i, r in rows.items() if language_id.judge(r.text, tuple(sorted(model.items())))[1] >= language_id.MARGIN}
    labels = {r.doc_id: r.quality for r in common.table(spark, FOLDER, "labels").collect()}
    first = docs.where(docs.doc_id.isin(sorted(stay)))
    trees = quality_classifier.fit(first, quality_classifier.training_labels(common.table(spark, FOLDER, "labels")))
    stay = {i for i in stay if trees.score(__import__("numpy").array([quality_classifier.describe(rows[i].text)]))[0] >= 0.3}
    assert sum(labels.get(i) == 0 for i in stay) <= 2
    stay = {i for i, _, g in groups([(i, plain(rows[i].text)) for i in sorted(stay)]) if i == g}
    items = [tuple(r) for r in common.table(spark, FOLDER, "benchmark").collect()]
    dirty = {eval(x)[0] for x in brute([(i, rows[i].text) for i in stay], items) if eval(x)[5]}
    stay -= dirty
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == stay
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in got[:50]:
        ids = [*library.encode(rows[r.doc_id].text, add_special_tokens=False).ids, packing.END][r.start : r.start + r.length]
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)) == r.ids_crc32


def test_folder_for_tables(spark, monkeypatch):
    assert common.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    made = common.written(spark.range(3), "probe")
    assert made.count() == 3 and re.search(r"/llm/probe-[0-9a-f]{32}", made.inputFiles()[0])
