"""Token counts by byte-pair merging with a heap and a linked list.

A word's bytes form a linked list of symbols. Every adjacent pair that the merge table knows
waits in a heap by its rank, the leftmost first; the lowest is popped, its two symbols become
one, and the pairs with the new neighbours join the heap. The count is the number of bytes
minus the number of merges. No identifier is ever made. A word of n bytes takes n log n steps,
however long it is.

Words recur, so each Python worker keeps the counts of up to ``CACHED`` words, half of them the
newest and half the generation before. Texts are read whole, in place, without a shuffle.

Defined results: null counts as the empty text, with no bytes and no tokens. The strings of
special tokens inside a text are one token each, as by the library's default.
"""

from __future__ import annotations

import functools
import heapq
import json
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.llm.common import per_batch, table

LIMIT = 512
CACHED = 800_000

#: The pattern that byte-level pre-tokenizers of this kind split by (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Code points whose Unicode class differs between the versions that libraries were built with.
#: Texts that hold one are split by the tokenizer's own pre-tokenizer (slower, same result).
UNSURE = r"[՘֋֌࢏౜೜₏₝-₟꟎-꭭\U000107bb-\U0010ffff]"


def byte_letters() -> dict[str, str]:
    """From the printable letters that byte-level vocabularies write for bytes to the bytes (as Latin-1)."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): chr(b) for b in plain} | {chr(256 + i): chr(b) for i, b in enumerate(rest)}


def merges_of(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges a list of symbols takes. The list is used up."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if (r := ranks.get((a, b))) is not None]
    heapq.heapify(heap)
    done = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j >= n or symbols[i] != a or symbols[j] != b:
            continue  # one of the two has gone into another merge
        done += 1
        symbols[i], symbols[j] = a + b, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
    return done


class Counter(dict):
    """Counts of words seen before; ``tokens`` counts a text."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec["pre_tokenizer"], spec["model"]
        if (split["type"], split["use_regex"], split["add_prefix_space"], spec["normalizer"]) != ("ByteLevel", True, False, None):
            raise ValueError(f"{path}: only plain byte-level pre-tokenizers are known")
        if model.get("ignore_merges") or any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError(f"{path}: unknown options")
        letters = {ord(k): v for k, v in byte_letters().items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a.translate(letters), b.translate(letters)): r for r, (a, b) in enumerate(pairs)}
        self.path, self.older = path, {}
        self.word, self.unsure = regex.compile(PATTERN), regex.compile(UNSURE)
        special = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")

    def __missing__(self, word: str) -> int:
        n = self.older.get(word)
        if n is None:
            symbols = list(word.encode().decode("latin-1"))
            n = len(symbols)
            n -= merges_of(symbols, self.ranks)
        if len(self) >= CACHED // 2:
            self.older = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = n
        return n

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).pre_tokenizer

    def part(self, text: str) -> int:
        """Tokens of a text without special strings; of a long one, some words at a time."""
        if self.unsure.search(text):
            words = (text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text))
            return sum(map(self.__getitem__, words))
        if len(text) <= 1 << 20:
            return sum(map(self.__getitem__, self.word.findall(text)))
        found, total = (m.group() for m in self.word.finditer(text)), 0
        while some := list(islice(found, 1 << 16)):
            total += sum(map(self.__getitem__, some))
        return total

    def tokens(self, text: str) -> int:
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += self.part(text[at : m.start()]) + 1
            at = m.end()
        return total + self.part(text[at:] if at else text)


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One for each tokenizer file in a Python worker."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text).

    ``path``: the tokenizer's JSON file, present on every executor.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(x: dict[str, list]) -> dict[str, list]:
        tokens = counter(path).tokens
        texts = [t or "" for t in x["text"]]
        counts = [tokens(t) for t in texts]
        return {"doc_id": x["doc_id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts, "over_limit": [n > limit for n in counts]}

    return per_batch(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
