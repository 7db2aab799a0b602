import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import documents, empty, odd_rows, row
from hushmark.llm import packing, token_counts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_against_the_library(spark, library):
    rows = odd_rows()
    got = sorted(map(repr, map(tuple, token_counts.count_tokens(documents(spark, rows), PATH).collect())))
    want = [(r[0], len((r[1] or "").encode()), n := len(ids(library, r[1])), n > 512) for r in rows]
    assert got == sorted(map(repr, want))


def test_empty_table(spark):
    assert token_counts.count_tokens(empty(spark), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["'s", " the", "<|endoftext|>", " ", "\x1c", "ñ", "12", "  \n"]), max_size=12).map("".join))
def test_any_text(text):
    library = Tokenizer.from_file(PATH)  # cheap after the first time
    assert token_counts.counter(PATH).tokens(text) == len(ids(library, text))
    assert packing.encoder(PATH).encode(text, allowed_special="all") == ids(library, text)


def test_splits_like_the_library_outside_the_guarded_letters(library):
    import regex

    unsure, word = regex.compile(token_counts.UNSURE), regex.compile(token_counts.PATTERN)
    letters = [chr(c) for c in range(0x107BB) if not 0xD800 <= c < 0xE000]
    letters = [c for c in letters if not unsure.match(c)]
    for at in range(0, len(letters), 2000):
        text = "".join(f"x{c}a {c}1{c}!" for c in letters[at : at + 2000])
        assert [m.span() for m in word.finditer(text)] == [s for _, s in library.pre_tokenizer.pre_tokenize_str(text)]


def test_cache_turns_over(monkeypatch, library):
    monkeypatch.setattr(token_counts, "CACHED", 8)
    counter = token_counts.Counter(PATH)
    text = " ".join(f"word{i} again{i % 3}" for i in range(200))
    assert counter.tokens(text) == len(ids(library, text))
    assert len(counter) <= 5


def check_places(rows, got, library, context):
    want = {}
    for doc_id, text in rows:
        want.setdefault(repr(doc_id), []).append(np.array([*ids(library, text), 1], dtype="<u4"))
    pieces, places = {}, {}
    for r in got:
        pieces.setdefault(repr(r.doc_id), []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces.keys() == want.keys()
    for k, docs in want.items():
        # repeated ids: their documents' pieces, told apart by length of the document
        for n in {len(a) for a in docs}:
            alike = [a for a in docs if len(a) == n]
            own = sorted(p for p in pieces[k] if p[3] == n)
            starts = sorted({p[0] for p in own})
            spans = list(zip(starts, [*starts[1:], n], strict=True))
            assert own == sorted((s, e - s, zlib.crc32(a[s:e].tobytes()), n) for a in alike for s, e in spans)
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= context
    return places


def test_packing(spark, library):
    rows = odd_rows()
    got = packing.pack(documents(spark, rows).repartition(5), PATH).collect()
    check_places([r[:2] for r in rows], got, library, 2048)
    short = packing.pack(documents(spark, rows).repartition(3), PATH, tiers=(8, 16, 32), step=4).collect()
    places = check_places([r[:2] for r in rows], short, library, 32)
    groups = {}
    for r in short:
        groups.setdefault(r.step_group, set()).add(r.sequence_id)
    assert max(map(len, groups.values())) - min(map(len, groups.values())) <= 1
    assert sum(n for p in places.values() for _, n in p) / (32 * len(places)) > 0.97
    assert all(r.tier == next(t for t in (8, 16, 32) if r.length <= t) for r in short)


def test_packing_without_short_pieces(spark, library):
    rows = [row(i, "alpha " * (620 + i % 7)) for i in range(90)]
    got = packing.pack(documents(spark, rows).repartition(4), PATH, tiers=(128, 256, 512, 1024)).collect()
    places = check_places([r[:2] for r in rows], got, library, 1024)
    assert sum(n for p in places.values() for _, n in p) / (1024 * len(places)) > 0.97


def test_cuts():
    assert packing.cuts(5000, (256, 512, 1024, 2048), True) == [2048, 2048, 904]
    assert packing.cuts(5000, (256, 512, 1024, 2048), False) == [2048, 2048, 512, 256, 136]
    assert packing.cuts(2048, (256, 512, 1024, 2048), True) == [2048]
    assert packing.cuts(1, (256, 2048), False) == [1]


def test_packing_nothing(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
    assert [(r.length, r.sequence_id, r.offset) for r in packing.pack(documents(spark, [row(1, None)]), PATH).collect()] == [(1, 0, 0)]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_plan_places_every_rank_once(counts):
    rows = packing.plan(counts, (8, 16, 64))
    seen, fill = {}, {}
    for length, first, times, copies, sequence, offset in rows:
        for rank in range(first, first + times * copies):
            assert rank not in seen.setdefault(length, set())
            seen[length].add(rank)
            s, o = sequence + (rank - first) // copies, offset + (rank - first) % copies * length
            fill.setdefault(s, []).append((o, length))
    assert {k: len(v) for k, v in seen.items()} == counts
    for parts in fill.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert sorted(fill) == list(range(len(fill)))


def test_long_runs_of_blanks(library):
    tail = "<|endoftext|> y" + "\t" * 1_200_000 + "'s z  "
    for text in ("a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "x <|endoftext|>" + " \n" * 1_000_000 + tail):
        assert np.array_equal(packing.ids_of(text, PATH), ids(library, text))


def test_packing_a_long_run_of_blanks(spark):
    got = packing.pack(documents(spark, [row(1, "a" + " " * 2_000_000 + "b"), row(2, "one")]), PATH).collect()
    n = {r.doc_id: r.doc_tokens for r in got}
    assert sum(r.length for r in got) == sum(n.values()) and n[2] == 2 and n[1] > 1
