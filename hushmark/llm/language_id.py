"""Language identification by compression.

For every language, its frequent words are a zstandard raw-content dictionary, the most frequent
last, where matches are cheapest. A document is encoded with each; the language whose dictionary
makes it smallest is the answer. How much smaller than the runner-up it came out, as a share, is
the score. A narrow margin is a rejection.

Only letters count: case is folded and everything between letters is one blank. The whole text is
encoded, in blocks, each against the dictionary alone, as a long text would otherwise become its own
dictionary. Short blocks are repeated, as zstandard stores what it can hardly compress. A margin
below ``REFINE`` is measured once more at the finest level; one below ``MARGIN`` is narrow.

The dictionaries are learned from a bounded sample: at most ``DOCS`` labelled documents of each
language, none over ``LONGEST`` characters, and hold ``DICTIONARY`` bytes of words. Prediction
reads only the text, in place, without a shuffle.

Defined results: a text that is null or without a letter is ``und``, score 0, rejected. Equal
sizes go to the language that comes first by name, score 0. Without any labelled document
everything is ``und``. Repeated rows get equal results.
"""

from __future__ import annotations

import functools
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.llm.common import bounded_sample, id_remainder, per_batch, table

DOCS = 300
LONGEST = 20_000
DICTIONARY = 64 * 1024
LEVEL, FINEST = 5, 19
BLOCK, SHORT = 2048, 256
REFINE = 0.02
MARGIN = 0.001
UNKNOWN = "und"


@functools.cache
def _between_letters():
    import regex

    return regex.compile(r"[^\p{L}]+")


def letters(text: str | None) -> str:
    """Lower-case letters with single blanks between and around them; empty without a letter."""
    kept = _between_letters().sub(" ", (text or "").lower()).strip()
    return f" {kept} " if kept else ""


def learn(docs: DataFrame, most: int = DOCS, size: int = DICTIONARY) -> dict[str, bytes]:
    """A dictionary for each language of ``docs`` (doc_id, text, lang); rows without either are left out.

    Driver memory: languages x documents x ``LONGEST`` characters at most.
    """
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.char_length("text").between(1, LONGEST)
    )
    drawn = bounded_sample(rows, "lang", most, "doc_id").collect()
    made: dict[str, bytes] = {}
    for lang in sorted({r.lang for r in drawn}):
        own = sorted((r for r in drawn if r.lang == lang), key=lambda r: (r._draw, str(r.doc_id)))[:most]
        often = Counter(w for r in own for w in letters(r.text).split())
        words, n = [], 0
        for word, _ in sorted(often.items(), key=lambda x: (-x[1], x[0])):
            if (n := n + len(word.encode()) + 1) > size:
                break
            words.append(word)
        made[lang] = f" {' '.join(reversed(words))} ".encode()
    return made


@functools.lru_cache(maxsize=4)
def _encoders(model: tuple[tuple[str, bytes], ...], level: int) -> list[tuple[str, object]]:
    import zstandard as z

    made = []
    for lang, content in model:
        words = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=level)
        made.append((lang, z.ZstdCompressor(dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False)))
    return made


def judge(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """Language and score of one text."""
    plain = letters(text)
    if not model or not plain:
        return UNKNOWN, 0.0
    blocks = [plain[at : at + BLOCK] for at in range(0, len(plain), BLOCK)]
    blocks = [(b * (SHORT // len(b) + 1) if len(b) < SHORT else b).encode() for b in blocks]
    best, score = UNKNOWN, 0.0
    for level in (LEVEL, FINEST):
        sizes = sorted((sum(len(e.compress(b)) for b in blocks), lang) for lang, e in _encoders(model, level))
        best, score = sizes[0][1], 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
        if score >= REFINE:
            break
    return best, score


def identify(docs: DataFrame, model: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row of ``docs`` (doc_id, text)."""
    kind, known = docs.schema["doc_id"].dataType.simpleString(), tuple(sorted(model.items()))

    def run(x: dict[str, list]) -> dict[str, list]:
        found = [judge(t, known) for t in x["text"]]
        return {"doc_id": x["doc_id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "rejected": [f[1] < margin for f in found]}

    return per_batch(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, all columns unchanged.

    The verdict is made in the same pass, so nothing is joined back.
    """
    from collections.abc import Iterator

    import pyarrow as pa

    from hushmark.llm.common import ship

    known = tuple(sorted(model.items()))
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield part.filter(pa.array([judge(t, known)[1] >= margin for t in part.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows that this corpus' dictionaries may be learned from: crc32 of the id modulo 4 is not 2."""
    return docs.where(id_remainder(F.col("doc_id"), 4) != 2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(training_rows(docs)))
    return found.select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
