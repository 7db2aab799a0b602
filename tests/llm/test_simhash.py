import random
import re

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from conftest import executed_plan
from fixtures import documents, empty, listed, odd_rows, row
from hushmark.llm import simhash


def plain(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(marks):
    """Smallest id reachable for (id, fingerprint) rows, by comparing all."""
    ids, parent = [i for i, _ in marks], list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(marks)):
        for b in range(a):
            if (marks[a][1] ^ marks[b][1]).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for x, i in enumerate(ids):
        r = find(x)
        least[r] = min((v for v in (least.get(r), i) if v is not None), default=None)
    return [(i, f"{m:016x}", least[find(x)]) for x, (i, m) in enumerate(marks)]


def test_brute_force(spark):
    rows = odd_rows()
    got = simhash.near_duplicates(documents(spark, rows))
    assert listed(got) == sorted(map(repr, groups([(r[0], plain(r[1])) for r in rows])))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_links_of_drawn_fingerprints(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1]
    marks = set(base)
    for f in base * 4:
        for _ in range(r.randrange(1, 5)):
            f ^= 1 << r.randrange(64)
        marks.add(f)
    marks = sorted(marks)
    signed = np.array(marks, dtype=np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(7)
    got = sorted((x.a, x.b) for x in simhash.links(fps).collect())
    want = sorted(
        (min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    )
    assert got == want


def test_every_pair_within_two_bits_of_one_value(spark):
    value = 0x0123456789ABCDEF
    marks = {value} | {value ^ 1 << i for i in range(64)} | {value ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)}
    signed = np.array(sorted(marks), dtype=np.uint64).view(np.int64).tolist()
    own = np.array([value], dtype=np.uint64).view(np.int64)[0]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    assert got.where(f"a = {own} or b = {own}").count() == 64 + 64 * 63 // 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5000), (6000, 6000)]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {5000: 5000, 5001: 5000}
    assert got == want


def test_long_texts_hash_in_parts(monkeypatch):
    text = " ".join(f"w{i % 701}" for i in range(70_000))
    assert simhash.fingerprint(text) == plain(text)


def test_keep_one(spark):
    rows = odd_rows() + [row(300, "same text here again"), row(301, "same text here again"), row(300, "same text here again")]
    docs = documents(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    marks = [(i, plain(r[1])) for i, r in enumerate(rows)]
    n = len({g for _, _, g in groups(marks)})
    assert kept.count() == n
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(300) == 1 and 301 not in ids and ids.count(1) == 1


@pytest.fixture
def planned(monkeypatch):
    """The plans, before and after they ran, of the links that are searched."""
    seen, find = [], simhash.links

    def links(*args):
        got = find(*args)
        seen.append(executed_plan(got))
        got.collect()
        seen.append(executed_plan(got))
        return got

    monkeypatch.setattr(simhash, "links", links)
    return seen


def test_pipeline_stage_never_broadcasts_replicas(spark, tmp_path, planned):
    documents(spark, odd_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")  # Spark knows the size of files
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert kept.count() == len({g for _, _, g in groups([(i, plain(r[1])) for i, r in enumerate(odd_rows())])})
    assert len(planned) == 2
    assert all("SortMergeJoin" in p and "Broadcast" not in p for p in planned)


def test_op6_broadcasts_no_rows_of_documents(spark, tmp_path, planned):
    documents(spark, odd_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    got = simhash.op6_simhash(spark, str(tmp_path))
    planned.append(executed_plan(got))
    assert listed(got) == sorted(map(repr, groups([(r[0], plain(r[1])) for r in odd_rows()])))
    planned.append(executed_plan(got))
    assert len(planned) == 4
    assert all("Broadcast" not in p for p in planned[:2])
    assert all(re.search(r"\w+Join", p).group() == "SortMergeJoin" for p in planned)  # the topmost
