"""Small tables with every odd case: nulls, empty and long texts, repeats, clashing columns."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n_words string, score string, fp string, term string, copy string, first string, tier string, value string, _id string, _copy string, _first string"
)

WORDS = ("alpha", "beta", "Gamma", "delta", "épsilon", "Zeta", "eta", "theta", "iota", "kappa", "ÉTA", "x1")


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None if text is None else len(text), *["clash"] * 11)


def odd_rows():
    r = random.Random(5)
    sentence = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    rows = [row(i, sentence(r.randrange(1, 60)) + ".\n" + sentence(r.randrange(1, 40))) for i in range(60)]
    rows += [row(100, None), row(101, ""), row(102, " \t\n"), row(103, "!!! ... ###"), row(104, "one"), row(105, "one two")]
    rows += [row(106, sentence(30_000)), row(107, "a" * 50_000), row(108, rows[0][1]), row(109, rows[0][1]), rows[1], rows[1]]
    rows += [row(None, "null id text goes here"), row(None, None), row(110, "<|endoftext|> special <|endoftext|>"), row(111, "日本語 текст 🎉 ok")]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df):
    return sorted(map(repr, map(tuple, df.collect())))
