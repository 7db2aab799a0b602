"""Large JSON files whose root is one array, read by all cores.

``multiLine`` JSON makes a file one task. Here each file is cut into byte ranges. Whether a byte is
inside a string, and how deep it lies, depends on everything before it, so two jobs run:

1. every range is scanned once, for both cases of starting inside or outside a string: the parity of
   its unescaped quotes and its change of bracket depth (a few numbers per range, gathered on the
   driver and chained per file, so each range learns its starting state);
2. every range, knowing its state, finds the elements of the root array that begin in it (a comma or
   the opening bracket at depth one), reads on past its end until its last element closes, and emits
   each element's JSON text. Spark's own ``from_json`` parses them.

The scans are vectorised over bytes (numpy): quotes preceded by an odd run of backslashes are
escaped; multi-byte UTF-8 characters never hold ASCII bytes, so bytes suffice. A file whose root is
not an array is one element, read by the range that holds its first byte. Files are opened through
``pyarrow.fs``, so local, HDFS and object-store paths work alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes per range.
RANGE = 64 << 20
QUOTE, BACKSLASH, COMMA = 34, 92, 44
OPEN, CLOSE = (91, 123), (93, 125)
BLANK = b" \t\r\n"


def _files(path: str, pattern: str) -> list[tuple[str, int]]:
    system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        found = [info]
    else:
        found = [i for i in system.get_file_info(fs.FileSelector(root, recursive=True)) if i.type == fs.FileType.File]
    import fnmatch

    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted((scheme + i.path, i.size) for i in found if fnmatch.fnmatch(i.base_name, pattern))


def _open(path: str):
    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def _backslashes_before(handle, at: int) -> int:
    """How many backslashes stand right before byte ``at``."""
    n, pos = 0, at
    while pos > 0:
        step = min(4096, pos)
        chunk = handle.read_at(step, pos - step)
        stripped = len(chunk) - len(chunk.rstrip(b"\\"))
        n += stripped
        if stripped < step:
            break
        pos -= step
    return n


def _structure(buf: bytes, inside: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: the byte, and whether it stands outside any string (for a start ``inside`` a string or not)."""
    b = np.frombuffer(buf, np.uint8)
    if len(b) == 0:
        return b, np.zeros(0, bool)
    idx = np.arange(len(b))
    plain = b != BACKSLASH
    last = np.maximum.accumulate(np.where(plain, idx, -1))
    prev_last = np.concatenate(([-1], last[:-1]))
    run = idx - 1 - prev_last + np.where(prev_last < 0, before, 0)
    real = (b == QUOTE) & (run % 2 == 0)
    flips = np.cumsum(real) - real  # quotes before each byte
    outside = ((flips + inside) % 2 == 0) & ~real
    return b, outside


def _real_quotes(buf: bytes, before: int) -> int:
    b = np.frombuffer(buf, np.uint8)
    if len(b) == 0:
        return 0
    idx = np.arange(len(b))
    last = np.maximum.accumulate(np.where(b != BACKSLASH, idx, -1))
    prev_last = np.concatenate(([-1], last[:-1]))
    run = idx - 1 - prev_last + np.where(prev_last < 0, before, 0)
    return int(((b == QUOTE) & (run % 2 == 0)).sum())


def _summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        out = []
        for r in df.itertuples(index=False):
            with _open(r.path) as h:
                buf = h.read_at(r.end - r.start, r.start)
                before = _backslashes_before(h, r.start)
            row = [r.path, r.start]
            for inside in (0, 1):
                b, outside = _structure(buf, inside, before)
                delta = int((np.isin(b, OPEN) & outside).sum() - (np.isin(b, CLOSE) & outside).sum())
                row.append(delta)
            # the unescaped quotes: their parity says whether the range ends inside a string
            row.append(int(_real_quotes(buf, before) % 2))
            out.append(row)
        yield pd.DataFrame(out, columns=["path", "start", "delta0", "delta1", "flip"])


def _elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        out = []
        for r in df.itertuples(index=False):
            out += _range_elements(r.path, r.start, r.end, r.size, int(r.inside), int(r.depth))
        yield pd.DataFrame(out, columns=["source_file", "offset", "value"])


def _range_elements(path: str, start: int, end: int, size: int, inside: int, depth: int) -> list[tuple[str, int, str]]:
    with _open(path) as h:
        before = _backslashes_before(h, start)
        length = end - start
        while True:
            buf = h.read_at(min(length, size - start), start)
            b, outside = _structure(buf, inside, before)
            opens = (np.isin(b, OPEN) & outside).astype(np.int64)
            closes = (np.isin(b, CLOSE) & outside).astype(np.int64)
            after = depth + np.cumsum(opens - closes)
            at = after + closes - opens  # depth before each byte
            if start == 0:
                head = buf.lstrip(BLANK)[:1]
                if head and head != b"[":
                    text = h.read_at(size, 0).decode("utf-8").strip()
                    return [(path, 0, text)] if text else []
            begins = np.flatnonzero(((b == COMMA) & outside & (at == 1)) | ((b == OPEN[0]) & outside & (at == 0)))
            stops = np.flatnonzero(((b == COMMA) & outside & (at == 1)) | ((b == CLOSE[0]) & outside & (at == 1)))
            begins = begins[begins < end - start]
            if len(begins) == 0:
                return []
            last_begin = begins[-1]
            if (stops > last_begin).any() or start + len(buf) >= size:
                break
            length *= 2
        made = []
        for s in begins:
            later = stops[stops > s]
            if len(later) == 0:
                break
            text = buf[s + 1 : later[0]].strip(BLANK)
            if text:
                made.append((path, start + int(s) + 1, text.decode("utf-8")))
        return made


def read_root_arrays(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.json", range_bytes: int = RANGE
) -> DataFrame:
    """The elements of the root arrays of all files below ``path``, parsed by ``schema``, with ``source_file``.

    Row order within a file is its ``offset``. Malformed elements give null columns (``from_json``).
    The driver holds the list of ranges and five numbers per range: one row per ``range_bytes`` of input
    (64 MB by default), not per element.
    """
    files = _files(path, pattern)
    ranges = [(p, s, min(s + range_bytes, n), n) for p, n in files for s in range(0, max(n, 1), range_bytes)]
    frame = spark.createDataFrame(ranges, "path string, start long, end long, size long")
    frame = frame.repartition(max(1, len(ranges)))
    summary = {(r.path, r.start): r for r in frame.mapInPandas(_summary, "path string, start long, delta0 long, delta1 long, flip long").collect()}
    states, inside, depth, last = [], 0, 0, None
    for p, s, e, n in ranges:
        if p != last:
            inside, depth, last = 0, 0, p
        states.append((p, s, e, n, inside, depth))
        r = summary[(p, s)]
        depth += r.delta1 if inside else r.delta0
        inside ^= int(r.flip)
    placed = spark.createDataFrame(states, "path string, start long, end long, size long, inside long, depth long")
    texts = placed.repartition(max(1, len(states))).mapInPandas(_elements, "source_file string, offset long, value string")
    return texts.select(F.from_json("value", schema).alias("r"), "source_file", "offset").select("r.*", "source_file", "offset")
