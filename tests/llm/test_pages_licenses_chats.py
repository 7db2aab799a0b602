import random
import re

import pytest
from fixtures import documents, empty, odd_rows, row
from hushmark.llm import license_rules, licenses, main_text, perspectives

PAGE = "page_id long, url string, html string"


def texts(spark, pages):
    return {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(pages, PAGE)).collect()}


def test_article_pages(spark):
    html = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><article>';</script></head><body>"
        "<nav><ul><li>Menu</li></ul></nav><!-- <p>no</p> --><div class='ad big'>Buy</div><article class=\"post\"><h1>The &amp; title</h1>"
        "<p><b>First   line<br>same\n block<p>Second &lt;p&gt; &copy; 3 < 4<ul><li>one<li>two</ul><form><p>name</p><input></form>"
        "<div class='comments'><p>great!</p></div><aside>more</aside><p>Last</article><footer>foot</footer></body>"
    )
    want = "The & title\nFirst line same block\nSecond <p> © 3 < 4\none\ntwo\nLast"
    got = texts(spark, [(1, "http://a.b/x", html), (2, "http://a.b/y", html.replace("article", "MAIN")), (3, None, None), (4, "u", ""), (None, "u", "<article>x")])
    assert got == {1: want, 2: want, 3: "", 4: "", None: "x"}


@pytest.mark.parametrize("html", ["<", "<<<", "<a", "</", "<article", "<article>a<", "<p>a</b></div>b<!--", "<article><script>x", "&amp", "<article>&#x110000;&#0;b"])
def test_broken_markup(html):
    main_text.blocks(html)


def test_host_runs(spark):
    menu = "<div>Home News Sport Weather Shop More About Contact us today</div>"
    own = lambda i: f"<div>q{i} " + " ".join(f"w{i}x{j}" for j in range(12)) + "</div>"
    pages = [(i, f"https://user@h.com:80/{i}", menu + own(i) + menu) for i in range(4)]
    pages += [(10, "http://other.com/", menu + own(10)), (11, "http://H.com/b", own(11) + "<p>a b c d</p>"), (12, "http://h.com/c", own(11) + "<p>a b c d</p>")]
    pages += [(20, "http://h.com/long", own(20) * 1 + "".join(f"<p>l{i} m{i}</p>" for i in range(5000)))]
    got = texts(spark, pages)
    line = lambda i: f"q{i} " + " ".join(f"w{i}x{j}" for j in range(12))
    assert all(got[i] == line(i) for i in range(4))
    assert got[10] == "Home News Sport Weather Shop More About Contact us today\n" + line(10)
    assert got[11] == got[12] == line(11) + "\na b c d"  # copies of one page are one page
    assert len(got[20].split("\n")) == 5001


def test_pages_extra_columns_and_nothing(spark):
    assert main_text.extract(spark.createDataFrame([], PAGE)).count() == 0
    rows = [(1, "u", "<article>a b</article>", "x", 5), (1, "u", "<article>a b</article>", "x", 5)]
    got = main_text.extract(spark.createDataFrame(rows, PAGE + ", text string, n_chars int")).collect()
    assert [tuple(r) for r in got] == [(1, "u", "a b", 3)] * 2


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<body class='no-sidebar'><article>a</article></body>", "a"),
        ("<html class=widget id='menu'><body class='sidebar'><main>a</main></body>", "a"),
        ("<div class='has-sidebar'><main>a</main><div class='sidebar'>x</div></div>", "a"),
        ("<div class='social'><main>a<div class='comment-list'>x</div>b</main></div>", "a\nb"),
        ("<form id='f'><div class='widget'><article>a</article></div></form>", "a"),
        ("<article><h2 id='related-work'>a</h2><p id='notice'>b</p><div id='widget-design'>c</div><h2 id=menu>d</h2></article>", "a\nb\nc\nd"),
        ("<article>a<div class='ad-slot'>x</div><p class='notice'>x</p><div class='big sponsored'>x</div><section role='navigation'>x</section></article>", "a"),
        ("<article>a</article><div class='related'><article>x</article></div><aside><article>x</article></aside>", "a"),
        ("<div class='comments'><article>x</article></div><article>a<div class='comments'><article>x</article></div></article>", "a"),
        ("<aside><article>x</article></aside><article></article>", ""),
        ("<aside><article>x</article></aside>", ""),
    ],
)
def test_marks_are_whole_names_beside_the_article(html, want):
    assert main_text.main_text(html) == want


def test_every_page_goes_through_the_host_array(spark):
    menu = "<div>Home News Sport Weather Shop More About Contact us today</div>"
    shared = "these nine words stand in two articles of it"
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(12))
    pages = [(1, "http://h.com/1", f"{menu}<article>{own(1)}<p>{shared}</article>"), (2, "http://h.com/2", f"<div>{own(2)}</div>{menu}<p>{shared}")]
    pages += [(3, "http://h.com/3", f"<article><p>{shared}</p>{own(3)}</article>"), (4, "http://h.com/4", "<p>short"), (5, None, None)]
    got = {r.page_id: (r.text, r.n_words, r.n_repeated) for r in main_text.measured(spark.createDataFrame(pages, PAGE)).collect()}
    assert got == {
        1: (f"{own(1)}\n{shared}", 31, 19),
        2: (f"{own(2)}\n{shared}", 31, 19),
        3: (f"{shared}\n{own(3)}", 21, 9),
        4: ("short", 1, 0),
        5: ("", 0, 0),
    }


def test_articles_not_shown_do_not_hide_the_text(spark):
    pages = [
        (1, "http://a.b/1", "<script>var x = '<article>';</script><div>plain text</div>"),
        (2, "http://a.b/2", "<aside><article>card</article></aside><div>plain text</div>"),
        (3, "http://a.b/3", "<!-- <main> --><div>plain text</div>"),
    ]
    assert texts(spark, pages) == dict.fromkeys((1, 2, 3), "plain text")


def brute_pages(pages, run):
    met, held, found = {}, set(), []
    for page_id, url, html in pages:
        host = re.sub(r"^http://([^/]*).*", r"\1", url)
        blocks, shown = main_text.shown_blocks(html)
        words = [(w, inside, b) for b, (inside, text) in enumerate(blocks) for w in text.split()]
        keys = [(host, *(w for w, _, _ in words[i : i + run])) for i in range(len(words) - run + 1)]
        for key, (_, inside, _) in zip(keys, words, strict=False):
            met.setdefault(key, set()).add(tuple(text for _, text in blocks))
            held |= {key} if inside else set()
        found.append((page_id, blocks, shown, words, keys))
    for page_id, blocks, shown, words, keys in found:
        repeated = {j for i, k in enumerate(keys) if len(met[k]) > 1 for j in range(i, i + run)}
        dropped = {j for i, k in enumerate(keys) if len(met[k]) > 1 and k not in held for j in range(i, i + run)}
        lines = [text for inside, text in blocks if inside] if shown else [
            " ".join(w for j, (w, _, at) in enumerate(words) if at == b and j not in dropped) for b in range(len(blocks))
        ]
        yield page_id, "\n".join(x for x in lines if x), len(words), len(repeated)


@pytest.mark.parametrize(("run", "bits"), [(8, (10, 30)), (5, (1, 3)), (1, (2, 2))])
def test_runs_against_brute_force(spark, monkeypatch, run, bits):
    # few bits meet by chance, which must not change a result; small lists make many of them
    monkeypatch.setattr(main_text, "SLOT_BITS", bits[0])
    monkeypatch.setattr(main_text, "REST_BITS", bits[1])
    monkeypatch.setattr(main_text, "LIST_SUFFIXES", 100)
    draw = random.Random(run)
    pool = [" ".join(draw.choice("abcdefgé") * draw.randint(1, 2 if run > 1 else 9) for _ in range(draw.randint(1, 14))) for _ in range(60)]
    pages = []
    for i in range(150):
        parts = [f"<p>{draw.choice(pool)}{draw.choice(['', ' ' + str(i), ' <b>own</b> x' + str(i)])}</p>" for _ in range(draw.randint(0, 6))]
        at = draw.randint(0, len(parts))
        kind = draw.choice(["{}<article>{}</article>", "{}{}", "{}<div class='ad'>{}</div>", "{}<main>{}</main><footer>a b c</footer>"])
        pages.append((i, f"http://{draw.choice(['a.com', 'b.org', 'c.net'])}/{i}", kind.format("".join(parts[:at]), "".join(parts[at:]))))
    pages += [(p[0] + 1000, p[1], p[2]) for p in draw.sample(pages, 40)]
    got = main_text.measured(spark.createDataFrame(pages, PAGE).repartition(3), run).collect()
    want = list(brute_pages(pages, run))
    assert sorted((r.page_id, r.text, r.n_words, r.n_repeated) for r in got) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in got) and any(0 < w[3] < w[2] for w in want)


# --- licences

TEXTS = [
    "Released under the MIT License. Again: UNDER THE mit LICENSE, under the mit license",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "CC BY-NC 4.0 and CC BY-NC-SA; cc by nc cc by nc",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3.",
    "SPDX-License-Identifier: BSD-3-Clause",
    "GNU Lesser General Public License v2.1; MIT licensed; dual-licensed",
    "all rights reserved. in the public domain. mozilla public license",
    "mit license " * 3000,
]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, table):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(i, label) for p, label in licenses.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    told, found = "".join(f"<{x} " for x in w), []
    for r in table:
        for m in re.finditer(r.pattern, told) if f"<{r.keyword} " in told else ():
            start = told[: m.start()].count("<")
            found.append((start, start + m.group().count("<") - 1, r))
    found.sort(key=lambda m: (m[0], -m[1], -m[2].priority, m[2].number))
    kept = []
    for i, (start, end, r) in enumerate(found):
        near = found[max(0, i - 60) : i]  # matches are short: what contains one starts close by
        if not any(o[1] >= end and o[2].priority >= r.priority for o in near):
            kept.append((start, end, r))
    labels = {label for _, label in places} | {r.label for _, _, r in kept}
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), len(kept)


def test_scan_against_brute_force(spark):
    rows = odd_rows() + [row(500 + i, t) for i, t in enumerate(TEXTS)]
    table = license_rules.rules()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.n_matches) for r in licenses.scan(documents(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(repr((r[0], *brute(r[1], table))) for r in rows)
    named = {g[0]: g[6] for g in got}
    assert named[500] == "mit" and named[501] == "apache-2" and named[503] == "gpl,gpl-3" or named[503] == "gpl"
    assert named[504] == "bsd-3-clause" and "lgpl-2.1" in named[505]
    assert licenses.scan(empty(spark)).count() == 0


def test_scan_is_native(spark, tiny):
    assert not re.search("Python|Pandas|Arrow", licenses.op7_license_scan(spark, tiny)._jdf.queryExecution().toString())


def test_every_rule_holds_its_keyword():
    table = license_rules.rules()
    assert len(table) > 300 and all(r.keyword and f"<(?:{re.escape(r.keyword)}) " in r.pattern for r in table)


# --- chats


def test_rotation(spark):
    turns = [
        (1, 0, "ann", "Hi"), (1, 1, "bob", None), (1, 2, "system", "note"), (1, 3, None, "who <|im_end|>"), (1, 4, "ann", ""),
        (1, 4, "ann", ""), (2, 0, "system", "alone"), (None, 5, "ann", "x"), (None, None, "bob", "first"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'x' as participant", "1 as start", "'y' as head", "2 as chunk")
    for chunk in (1000, 2):
        rows = perspectives.rotate(df, chunk).collect()
        whole = {}
        for r in sorted(rows, key=lambda r: r.start):
            key = (r.conv_id, r.participant)
            assert r.start == len(whole.get(key, "")) and r.end == r.start + len(r.segment)
            whole[key] = whole.get(key, "") + r.segment
        a, b = "<|im_start|>", "<|im_end|>\n"
        rest = f"{a}system\nnote{b}{a}user name=unknown\nwho <|im_end|>{b}"
        assert whole[1, "ann"] == f"{a}assistant\nHi{b}{a}user name=bob\n{b}{rest}{a}assistant\n{b}" + f"{a}assistant\n{b}"
        assert whole[1, "bob"] == f"{a}user name=ann\nHi{b}{a}assistant\n{b}{rest}" + f"{a}user name=ann\n{b}" * 2
        assert whole[None, "ann"] == f"{a}user name=bob\nfirst{b}{a}assistant\nx{b}"
        assert set(whole) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (None, "bob")}
        for r in rows:
            own = whole[r.conv_id, r.participant]
            assert r.trained == (r.speaker == r.participant) == (r.mask_start is not None)
            if r.trained:
                assert own[: r.mask_start].endswith("assistant\n") and own[r.mask_end :].startswith(b)
    assert perspectives.rotate(df.limit(0)).count() == 0
