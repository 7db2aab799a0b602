import random

import corpus_pipeline
import numpy as np
import pytest
from fixtures import documents, empty, odd_rows, row
from hushmark.llm import near_copies, simhash


def plain(text, size=5):
    w = [x.lower() for x in (text or "").encode().split()]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def groups(rows):
    """Smallest id reachable for (id, text) rows, by comparing all."""
    sets, parent = [plain(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min((v for v in (least.get(find(x)), i) if v is not None), default=None)
    return sorted(repr((i, least[find(x)])) for x, (i, _) in enumerate(rows))


def edited(r, words, times):
    words = list(words)
    for _ in range(times):
        at = r.randrange(len(words))
        words[at : at + r.randrange(2)] = [f"new{r.randrange(10**6)}"]
    return words


def near_rows():
    """Chains of edits around 0.8, one group of alike texts, and one passage that many other texts hold."""
    r = random.Random(8)
    rows, passage = odd_rows(), [f"p{i}" for i in range(30)]
    for g in range(12):
        words = [f"g{g}w{r.randrange(500)}" for _ in range(r.randrange(20, 150))]
        for k in range(8):
            rows.append(row(1000 + g * 20 + k, " ".join(words)))
            words = edited(r, words, r.choice((1, 1, 2, 5)))
    whole = [f"h{i}" for i in range(200)]
    rows += [row(2000 + i, " ".join(edited(r, whole, 1 + i % 6))) for i in range(120)]
    for i in range(80):
        own = [f"o{i}x{j}" for j in range(r.randrange(1, 40))]
        rows.append(row(3000 + i, " ".join(passage + own)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("rounds", "per_posting", "common"), [(6, 4, 5), (6, 0, 10**9), (0, 4, 10**9), (2, 0, 5)])
def test_brute_force(spark, monkeypatch, rounds, per_posting, common):
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    monkeypatch.setattr(near_copies, "PER_POSTING", per_posting)
    monkeypatch.setattr(near_copies, "COMMON", common)
    rows = near_rows()
    got = near_copies.near_duplicates(documents(spark, rows).repartition(5)).select("doc_id", "component_id")
    assert sorted(repr(tuple(x)) for x in got.collect()) == groups([x[:2] for x in rows])


def test_pipeline_stage_links_by_simhash_bits(spark):
    """The stage calls the SimHash operator (3-word shingles, 2 bits) and no word-similarity check."""
    words = [f"w{i}" for i in range(100)]
    near, far = [*words[:50], "other", *words[51:]], [w if i % 20 else "other" for i, w in enumerate(words)]
    assert (simhash.fingerprint(" ".join(words)) ^ simhash.fingerprint(" ".join(near))).bit_count() > 2
    docs = documents(spark, [row(1, " ".join(words)), row(2, " ".join(near)), row(3, " ".join(far)), row(4, " ".join(near).upper())])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    # 4 lower-cases to 2's text: same fingerprint, the larger id goes; 1 and 2 differ in more than two bits
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == [1, 2, 3]
    assert corpus_pipeline.drop_near_duplicates(spark, empty(spark), "").count() == 0


def test_similar_sets_share_a_first_shingle():
    r = np.random.default_rng(4)
    for _ in range(300):
        n, extra = r.integers(1, 60), r.integers(0, 20)
        a = np.unique(r.integers(0, 10**6, n))
        b = np.unique(np.concatenate([a[r.integers(0, max(1, len(a) // 4)) :], r.integers(0, 10**6, extra)]))
        common = np.unique(r.choice(a, len(a) // 2))
        if 5 * len(both := np.intersect1d(a, b)) >= 4 * (len(a) + len(b) - len(both)):
            assert np.intersect1d(near_copies.prefix(a, common), near_copies.prefix(b, common)).size
