"""Main text of web pages: the runs of a host's suffix array, checked against the page's structure.

A page's markup is cut into blocks. Menus, headers, footers, sidebars, forms, scripts, adverts, notices and
reader comments are set apart by their markup, wherever they stand. The words of the blocks left, over the
whole page, are its token stream.

Every page goes through its host's suffix array. Each suffix of each stream is named by its host and its
first ``RUN`` words, the names made by prefix doubling (one word, two, four, ...). The names are dealt out by
range and sorted, so that suffixes that share ``RUN`` words are neighbours. A prefix met in two pages of
different content is a repeated run, longer repeats are the union of such prefixes, and all else is
unique runs. No host is gathered anywhere. What travels is 40 bits of a name and a page number, sorted and
coded by their gaps (``suffix_lists``); pages whose suffixes met in these bits are read once more, and
what they share is settled by 128 bits (``repeated_runs``), so the bits that travel decide nothing.

Structure then checks the runs. A page's article or main element is its text, whole: sentences that
several articles share belong to each of them, so a repeated run does not take them away, and what stands beside the
article does not become text by being unique. On pages that show no such element, the unique runs are
the text and the repeated ones boilerplate, unless an article element of the host holds the same run. For every
page the words of its stream and how many of them stand in repeated runs are returned as well.

Defined results: a null html is empty, its text is empty; a null url is a host of its own; repeated rows
get a result each, and exact copies of a page (the same blocks) count as one page when runs are looked for; a page
without blocks has an empty text. An article in a script, a comment or an element set apart is not shown.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.llm.common import BROADCAST_CHARS, BROADCAST_ROWS, per_batch, ship, table, written

RUN = 8

#: Bits of a prefix's name that travel first: those that choose its range, and the others.
SLOT_BITS, REST_BITS = 10, 30
#: Pages and suffixes of a sorted list; a page's number in it takes ``PAGE_BITS``.
PAGE_BITS = 12
LIST_SUFFIXES = 2_000_000

#: Elements that open a new block. Others stand inside a line.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no text at all.
RAW = frozenset("script style noscript template textarea title iframe svg math select object canvas audio video".split())
#: Elements that are not part of the article.
ASIDE = frozenset("nav header footer aside form menu dialog button search head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new block of the named kinds ends.
ENDS_P = BLOCKS - {"body", "html"}
#: Class, id or role words of what is not part of the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies disqus footer gdpr header menu nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
MAIN = re.compile(r"(?is)<(?:article|main)[\s/>]|<[a-z][^<>]*\brole\s*=\s*[\"']?main\b")

TAG = re.compile(r"(?s)<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)")
NAMED = re.compile(r"(?is)(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
PARTS = re.compile(r"[-_]+")
#: What may stand beside such words in a compound: ``comment-list``, but not ``no-sidebar`` or ``widget-design``.
FRAMES = frozenset(
    "area bar block box button buttons container form holder icons inner item items label links list outer panel post posts section site "
    "slot unit wrap wrapper".split()
)
#: Elements whose id is the slug of their words, and those whose marks tell of the page.
SLUGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p".split())
PAGE = frozenset("html body".split())


@functools.cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"(?is)</{re.escape(name)}\s*>")


@functools.lru_cache(maxsize=10_000)
def _is_mark(token: str) -> bool:
    """Whether a whole class, id or role says what is not part of the article."""
    parts = [x for x in PARTS.split(token) if x]
    return not MARKS.isdisjoint(parts) and all(x in MARKS or x in FRAMES for x in parts)


def _marked(name: str, attributes: str) -> bool:
    if not attributes or "=" not in attributes or name in PAGE:
        return False
    return any(
        any(map(_is_mark, (a or b or c).lower().split())) for kind, a, b, c in NAMED.findall(attributes) if not (name in SLUGS and kind.lower() == "id")
    )


def _is_main(name: str, attributes: str) -> bool:
    return name in ("article", "main") or bool(attributes) and "role" in attributes.lower() and bool(MAIN.match(f"<{name} {attributes}>"))


def blocks(html: str | None) -> list[tuple[bool, str]]:
    """(inside an article, text) of every block in page order that isn't set apart by its markup.

    A main element is never set apart. Nor are the articles of a page by marks or a form around them, where
    no article stands outside of such: those hold the page, not what is beside the article.
    """
    return shown_blocks(html)[0]


def shown_blocks(html: str | None) -> tuple[list[tuple[bool, str]], bool]:
    """The blocks, and whether the page shows an article or main element."""
    found, shown, hidden = _blocks(html or "", False)
    if hidden and not shown:
        found, shown, _ = _blocks(html or "", True)
    return found, shown


def _blocks(html: str, freed: bool) -> tuple[list[tuple[bool, str]], bool, bool]:
    """The blocks, whether an article is shown, whether one is set apart; ``freed`` lets articles out of marked elements and forms."""
    found: list[tuple[bool, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # open elements: name, set apart (1 by marks or a form, 2 by kind), inside an article
    apart, inside, shown, hidden = 0, False, False, False

    def close_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append((inside, text))
            pieces.clear()

    def drop_to(depth: int) -> None:
        nonlocal apart, inside
        close_block()
        del stack[depth:]
        apart, inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)

    at, size = 0, len(html)
    while at < size:
        m = TAG.search(html, at)
        if not apart:
            raw = html[at : m.start() if m else size]
            if raw:
                pieces.append(unescape(raw) if "&" in raw else raw)
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in BLOCKS or name in ASIDE:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if depth is not None:
                    drop_to(depth)
                else:
                    close_block()
            continue
        attributes = m[3]
        if name in RAW and not attributes.endswith("/"):
            end = _raw_end(name).search(html, at)
            at = end.end() if end else size
            if not apart:
                pieces.append(" ")
            continue
        if name == "br":
            if not apart:
                pieces.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        if name in ENDS_P and stack and stack[-1][0] == "p":
            drop_to(len(stack) - 1)
        if name in BLOCKS or name in ASIDE:
            close_block()
            if name == "hr":
                continue
            main = _is_main(name, attributes)
            # a heading's frame inside the article belongs to it
            if main:
                off = 0 if name != "article" or freed and apart == 1 else apart
                shown, hidden = shown or not off, hidden or bool(off)
            elif name in ASIDE and name != "form" and not (name == "header" and inside):
                off = 2
            else:
                off = apart or int(name == "form" or _marked(name, attributes))
            stack.append((name, off, inside or main))
            apart, inside = off, inside or main
    close_block()
    return found, shown, hidden


def main_text(html: str | None) -> str:
    """The text of a page that marks its article."""
    return "\n".join(text for inside, text in blocks(html) if inside)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def prefix_names(streams: list[list[str]], hosts: list[str], run: int, seeds: tuple[int, ...] = (0,)) -> list[list[np.ndarray]]:
    """For each seed and stream, 64-bit names of its suffixes by host and first ``run`` words; by prefix doubling.

    Suffixes of fewer words have none.
    """
    flat = np.array([w for s in streams for w in s], dtype=object)
    words = hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    of_host = hash_array(np.array(hosts, dtype=object)) if hosts else np.zeros(0, np.uint64)
    return [_by_stream(_mix(words, np.full(1, seed, np.uint64)), [len(s) for s in streams], of_host, run) for seed in seeds]


def _by_stream(names: np.ndarray, sizes: list[int], of_host: np.ndarray, run: int) -> list[np.ndarray]:
    width = 1
    while width < run and len(names):
        step = min(width, run - width)
        names = _mix(names[: max(0, len(names) - step)], names[step:])
        width += step
    found, at = [], 0
    for words, host in zip(sizes, of_host, strict=True):
        found.append(_mix(names[at : at + max(0, words - run + 1)], np.full(1, host, np.uint64)))
        at += words
    return found


def _number(*parts: str | bytes) -> int:
    h = blake2b(digest_size=8)
    for x in parts:
        h.update(x if isinstance(x, bytes) else x.encode())
    return int.from_bytes(h.digest(), "little", signed=True)


def _stream(html: str | None) -> tuple[list[tuple[bool, str]], bool, list[str]]:
    found, shown = shown_blocks(html)
    return found, shown, [w for _, text in found for w in text.split(" ")]


def _content(host: str, found: list[tuple[bool, str]]) -> int:
    return _number(host, *(f"\n{text}" for _, text in found))


def _coded(values: np.ndarray) -> bytes:
    """Sorted numbers by their gaps, bytes of one rank together; the low four, as good as random, are left as they are."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = gaps.view(np.uint8).reshape(-1, 8).T
    return planes[:4].tobytes() + zlib.compress(planes[4:].tobytes(), 1)


def _decoded(coded: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(coded[: 4 * size] + zlib.decompress(coded[4 * size :]), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().cumsum(dtype=np.uint64)


LISTS = "slot int, list long, coded binary, number int, raw long, content long"


def suffix_lists(pages: DataFrame, run: int = RUN) -> DataFrame:
    """The suffixes of ``pages`` (host, raw, html) as sorted lists, cut by ``slot``, the first bits of their names.

    An entry is the rest of a name and the number of its page in the list, once for each prefix of a page and
    content; ``number`` says how many there are. Rows of a slot below zero say which page (raw) and content a number stands for.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(pages.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(LISTS))
    slots = np.arange(1 << SLOT_BITS, dtype=np.uint64) << np.uint64(REST_BITS + PAGE_BITS)

    def made(entries: list[np.ndarray], numbers: dict[int, int], heads: set[tuple[int, int]]) -> pa.RecordBatch:
        # by content, so that a task that runs again makes the same list
        name = _number(*(c.to_bytes(8, "little", signed=True) for c in numbers))
        rows = {"slot": [], "list": [], "coded": [], "number": [], "raw": [], "content": []}
        every = np.sort(np.concatenate(entries)) if entries else np.zeros(0, np.uint64)
        cuts = [*np.searchsorted(every, slots), len(every)]
        told = [(i, _coded(every[a:b] - slots[i]), b - a, None, None) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        told += [(-1 - raw % (1 << SLOT_BITS), None, numbers[content], raw, content) for raw, content in heads]
        for row in told:
            for column, value in zip(("slot", "coded", "number", "raw", "content"), row, strict=True):
                rows[column].append(value)
        rows["list"] = [name] * len(told)
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in out], schema=out)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, numbers, heads, held = [], {}, set(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                new = []
                for host, raw, html in zip(part["host"], part["raw"], part["html"], strict=True):
                    found, _, stream = _stream(html)
                    if len(stream) < run:
                        continue
                    content = _content(host, found)
                    heads.add((raw, content))
                    if content not in numbers:
                        numbers[content] = len(numbers)
                        new.append((numbers[content], stream, host))
                for (number, _, _), names in zip(new, *prefix_names([n[1] for n in new], [n[2] for n in new], run), strict=True):
                    short = np.unique(names >> np.uint64(64 - SLOT_BITS - REST_BITS))
                    entries.append((short << np.uint64(PAGE_BITS)) | np.uint64(number))
                    held += len(short)
                if held >= LIST_SUFFIXES or len(numbers) > (1 << PAGE_BITS) - 256 or len(heads) >= 1 << PAGE_BITS:
                    yield made(entries, numbers, heads)
                    entries, numbers, heads, held = [], {}, set(), 0
        if heads:
            yield made(entries, numbers, heads)

    return pages.select("host", "raw", "html").mapInArrow(lists, LISTS)


def meeting_pages(lists: DataFrame) -> DataFrame:
    """(raw, prefixes array<long>): short names of each page that stand in pages of different content."""
    schema = "list long, number int, prefix long, raw long, content long"

    def meet(group: pa.Table) -> pa.Table:
        slot = group.column("slot")[0].as_py()
        if slot < 0:
            prefix = pa.nulls(group.num_rows, pa.int64())
            return pa.table([group.column("list"), group.column("number"), prefix, group.column("raw"), group.column("content")], names=names)
        parts = [_decoded(x, n) for x, n in zip(group.column("coded").to_pylist(), group.column("number").to_pylist(), strict=True)]
        of = np.repeat(group.column("list").to_numpy(), [len(p) for p in parts])
        every = np.concatenate(parts)
        order = np.argsort(every >> np.uint64(PAGE_BITS), kind="stable")
        every, of = every[order], of[order]
        prefix = every >> np.uint64(PAGE_BITS)
        same = prefix[1:] == prefix[:-1]  # neighbours that share their first words
        hit = np.append(same, False) | np.append(False, same)
        nothing = pa.nulls(int(hit.sum()), pa.int64())
        number = (every[hit] & np.uint64((1 << PAGE_BITS) - 1)).astype(np.int32)
        return pa.table([of[hit], number, (prefix[hit] | np.uint64(slot << REST_BITS)).astype(np.int64), nothing, nothing], names=names)

    names = [x.split()[0] for x in schema.split(", ")]
    met = written(lists.groupBy("slot").applyInArrow(meet, schema), "met-suffixes")
    heads = met.where("content is not null").select("list", "number", "raw", "content").distinct()
    hits = met.where("prefix is not null").select("list", "number", "prefix")
    hits = hits.join(heads.select("list", "number", "content").distinct(), ["list", "number"]).select("content", "prefix").distinct()
    shared = hits.groupBy("prefix").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a <> b").select("prefix")
    prefixes = hits.join(shared, "prefix", "left_semi").groupBy("content").agg(F.collect_set("prefix").alias("prefixes"))
    return heads.select("raw", "content").distinct().join(prefixes, "content").groupBy("raw").agg(F.first("prefixes").alias("prefixes"))


def _to_pages(made: DataFrame, size) -> DataFrame:
    """Hint a broadcast of a small table by page, so that the pages' html stays where it is."""
    n, held = made.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(made) if n <= BROADCAST_ROWS and held <= BROADCAST_CHARS else made


def repeated_runs(pages: DataFrame, run: int = RUN) -> DataFrame:
    """(raw, n_repeated long, dropped array<int>) of pages with repeated runs; ``pages`` (host, raw, html), html alike for a raw.

    n_repeated: words of the stream in repeated runs; dropped: where those start that no article element of the host holds.
    """
    pages = pages.select("host", "raw", "html")
    wanted = written(meeting_pages(suffix_lists(pages, run)), "meeting-pages")

    def runs(x: dict[str, list]) -> dict[str, list]:
        pages = [(raw, *_stream(html), host, prefixes) for raw, html, host, prefixes in zip(x["raw"], x["html"], x["host"], x["prefixes"], strict=True)]
        made = {k: [] for k in ("raw", "content", "i", "first", "second", "article")}
        named = zip(pages, *prefix_names([p[3] for p in pages], [p[4] for p in pages], run, (0, 1)), strict=True)
        for (raw, found, _, _, host, prefixes), first, second in named:
            short = (first >> np.uint64(64 - SLOT_BITS - REST_BITS)).astype(np.int64)
            at = np.flatnonzero(np.isin(short, np.array(prefixes, np.int64)))
            inside = np.repeat([b for b, _ in found], [text.count(" ") + 1 for _, text in found])
            for column, values in zip(
                made, ([raw] * len(at), [_content(host, found)] * len(at), at, first[at].view(np.int64), second[at].view(np.int64), inside[at]), strict=True
            ):
                made[column].extend(values)
        return made

    met = pages.join(_to_pages(wanted, F.size("prefixes")), "raw")
    marks = written(per_batch(met, runs, "raw long, content long, i int, first long, second long, article boolean"), "page-runs").distinct()
    key = ["first", "second"]
    shared = marks.groupBy(*key).agg(F.min("content").alias("a"), F.max("content").alias("b"), F.max("article").alias("held")).where("a <> b")
    starts = marks.select("raw", "i", *key).join(shared.select(*key, "held"), key).groupBy("raw")
    starts = starts.agg(F.collect_set("i").alias("starts"), F.collect_set(F.when(~F.col("held"), F.col("i"))).alias("dropped"))
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda i: F.sequence(i, i + F.lit(run - 1)))))
    return starts.select("raw", F.size(covered).cast("long").alias("n_repeated"), "dropped")


def page_text(found: list[tuple[bool, str]], shown: bool, dropped: list[int] | None, run: int) -> str:
    """The article where the page shows one, else what the repeated runs that start at ``dropped`` leave."""
    if shown:
        return "\n".join(text for inside, text in found if inside)
    covered = {j for i in dropped or () for j in range(i, i + run)}
    lines, at = [], 0
    for _, text in found:
        words = text.split(" ")
        lines.append(" ".join(w for j, w in enumerate(words, at) if j not in covered))
        at += len(words)
    return "\n".join(x for x in lines if x)


def measured(pages: DataFrame, run: int = RUN) -> DataFrame:
    """(page_id, url, text, n_chars, n_words, n_repeated) for every row of ``pages`` (page_id, url, html).

    n_words: words of the page without what its markup sets apart; n_repeated: those in runs that another page of the host has too.
    """
    pages = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pages.withColumn("host", host).withColumn("raw", F.xxhash64("host", "html"))
    repeats = written(repeated_runs(pages, run), "repeated-runs")

    def settled(x: dict[str, list]) -> dict[str, list]:
        found = [shown_blocks(h) for h in x["html"]]
        texts = [page_text(*f, dropped, run) for f, dropped in zip(found, x["dropped"], strict=True)]
        words = [sum(text.count(" ") + 1 for _, text in f) for f, _ in found]
        return {"page_id": x["page_id"], "url": x["url"], "text": texts, "n_words": words, "n_repeated": [n or 0 for n in x["n_repeated"]]}

    rows = pages.join(_to_pages(repeats, F.size("dropped")), "raw", "left").select("page_id", "url", "html", "n_repeated", "dropped")
    done = per_batch(rows, settled, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_words long, n_repeated long")
    return done.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_words", "n_repeated")


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    return measured(pages, run).select("page_id", "url", "text", "n_chars")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "pages"))
