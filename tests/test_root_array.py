"""The splittable root-array reader against Spark's whole-file multiLine reader."""

import json
import random

from hushmark.sources import corpus
from hushmark.sources.root_array import read_root_arrays

TRICKY = ['a, b', 'x ] y', '{"k": [1, 2]}', 'quote " inside', 'back\\slash', 'ends with \\', 'ñ 日本 🎉', '', '\\"', '],[']


def conversations(rng, n):
    made = []
    for i in range(n):
        msgs = [{"message_id": f"m{i}-{j}", "text": rng.choice(TRICKY) + str(j), "author": rng.choice(["a", "b", None])} for j in range(rng.randint(0, 4))]
        made.append({"conversation_id": f"c{i}", "messages": msgs})
    return made


def test_equal_to_multiline(spark, tmp_path):
    rng = random.Random(4)
    for k, n in enumerate([0, 1, 40, 120]):
        (tmp_path / f"f{k}.json").write_text(json.dumps(conversations(rng, n), ensure_ascii=k % 2 == 0, indent=k % 3 or None))
    (tmp_path / "single.json").write_text(json.dumps(conversations(rng, 1)[0]))
    want = corpus.read_corpus(spark, str(tmp_path), schema=corpus.CORPUS)
    key = lambda r: (r["source_file"].split("/")[-1], r["conversation_id"], json.dumps(r["messages"]))
    expected = sorted(key(r.asDict(recursive=True)) for r in want.collect())
    for size in (61, 1 << 20):
        got = read_root_arrays(spark, str(tmp_path), corpus.CORPUS, range_bytes=size)
        assert sorted(key(r.asDict(recursive=True)) for r in got.collect()) == expected


def test_order_kept_by_offset(spark, tmp_path):
    rng = random.Random(5)
    items = conversations(rng, 120)
    (tmp_path / "one.json").write_text(json.dumps(items))
    got = read_root_arrays(spark, str(tmp_path), corpus.CORPUS, range_bytes=200).orderBy("offset").collect()
    assert [r.conversation_id for r in got] == [c["conversation_id"] for c in items]
