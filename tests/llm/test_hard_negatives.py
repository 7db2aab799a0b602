"""Hard negatives through the tree against a brute-force scan of all rows."""

import math
import random

import numpy as np
import pytest
from hushmark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def brute(rows):
    """Rows of the contract by scoring every anchor against every row."""
    ok = []
    for vid, emb, label, _ in rows:
        if label is None or emb is None or any(x is None or not math.isfinite(x) for x in emb):
            continue
        lab = (label + 1) % 10 if vid % 7 == 0 else label
        ok.append((vid, lab, np.array([math.floor(256 * float(np.float32(x))) for x in emb], np.int64)))
    out = []
    for aid, alab, aq in ok:
        if aid % 100:
            continue
        scored = sorted(((-int(q @ aq), vid, lab) for vid, lab, q in ok), key=lambda t: (t[0], t[1]))
        pos = [(vid, -s) for s, vid, lab in scored if lab == alab and vid != aid][:5]
        for pid, ps in pos:
            negs = [(vid, -s) for s, vid, lab in scored if lab != alab and 30 * ps <= 100 * -s <= 90 * ps][:10]
            out += [(aid, pid, r + 1, nid, ps, ns) for r, (nid, ns) in enumerate(negs)]
    return sorted(out)


def made(n, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        base = [r.gauss(0, 1) for _ in range(8)]
        rows.append((i, base, r.randrange(10), "x"))
    rows += [(200, [1.0] * 8, 3, "y"), (300, [1.0] * 8, 3, "y"), (301, [1.0] * 8, 3, "y"), (302, [1.0] * 8, 4, "y")]
    rows += [(400, None, 1, None), (500, [1.0, None] + [0.0] * 6, 1, None), (600, [float("nan")] + [0.0] * 7, 2, None), (700, [1.0] * 8, None, None)]
    rows += [(800, [0.5] * 8, 5, None), (800, [0.5] * 8, 5, None), (900, [-1.0] * 8, 5, None)]
    return rows


@pytest.mark.parametrize("chunk,block,sample", [(2048, 256, 4096), (7, 2, 40)])
def test_against_brute(spark, monkeypatch, chunk, block, sample):
    monkeypatch.setattr(hn, "CHUNK", chunk)
    monkeypatch.setattr(hn, "BLOCK", block)
    rows = made(1000)
    got = sorted(tuple(r) for r in hn.mine(spark.createDataFrame(rows, SCHEMA), sample).collect())
    assert got == brute(rows) and len(got) > 100


def test_empty(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.mine(spark.createDataFrame([(400, None, 1, None)], SCHEMA)).count() == 0


def test_query_whole_table(spark):
    from test_queries import FOLDER

    rows = [tuple(r) + (None,) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in hn.op12_hard_negatives(spark, FOLDER).collect())
    assert got == brute(rows)
