"""Helpers shared by the corpus operators: batches of bounded bytes, words, hashes, free column names."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a Python task works on at a time (one longer text is a slice of its own).
SLICE_BYTES = 4 << 20

#: A-Z to lower case; every other ASCII character that is not a digit or a letter to a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes after lower-casing A-Z."""
    return text.translate(_WORD_BYTES).split()


def plain_text(text: bytes) -> bytes:
    """The words of :func:`plain_words` between single spaces, with one at either end; empty if none."""
    words = plain_words(text)
    return b" " + b" ".join(words) + b" " if words else b""


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Non-empty row slices of the batches with at most ``max_bytes`` of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum([len(x) if x is not None else 0 for x in texts(batch, column, None)])
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts(batch: pa.RecordBatch, column: str, null: bytes | None = b"") -> list[bytes]:
    """UTF-8 bytes of a text column; ``null`` where it is null."""
    out = batch.column(column).cast(pa.large_binary()).to_pylist()
    return [null if x is None else x for x in out]


def joined(parts: list[bytes], sep: bytes = b"") -> tuple[bytes, np.ndarray]:
    """The parts in one buffer, and the offsets of their starts (one more at the end)."""
    sizes = np.fromiter((len(p) + len(sep) for p in parts), np.int64, len(parts))
    return sep.join(parts) + sep, np.concatenate(([0], np.cumsum(sizes)))


def per_row(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive ``starts``."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[starts[1:]] - total[starts[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift) over uint64."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def kept_in_worker(key: tuple, make):
    """An object that a Python worker process makes once and keeps for its later tasks (a cache, never data of a task).

    What was kept under the key of another operator goes first, so a worker that
    serves one operator after the other holds the tables of one.
    """
    kept = sys.modules.setdefault("_storeloom_kept", types.ModuleType("_storeloom_kept")).__dict__.setdefault("objects", {})
    for other in [k for k in kept if k[0] != key[0]]:
        del kept[other]
    if key not in kept:
        kept[key] = make()
    return kept[key]


def nothing_kept() -> None:
    """Let go of what this worker process keeps: for operators that keep nothing themselves."""
    module = sys.modules.get("_storeloom_kept")
    if module is not None:
        module.__dict__.pop("objects", None)


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with further columns."""
    return pa.RecordBatch.from_arrays(list(batch.columns) + list(columns.values()),
                                      names=list(batch.schema.names) + list(columns))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (compared without case, as Spark does)."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base += "_"
    return base


def text_digest(text: Column) -> Column:
    """128-bit identity of a text: MD5 of its UTF-8 bytes; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def least_hashes(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` distinct rows of (id, label): those with the least hashes of their ids, or of a part of them.

    From a large table only about twice as many rows as wanted are sorted: those
    whose hash falls into one of equal classes, so no task meets many rows.
    """
    ids = ids.distinct()
    n = ids.count()
    if n > 8 * rows:
        ids = ids.where(F.pmod(F.xxhash64(F.lit(41), "id"), F.lit(n // (2 * rows))) == 0)
    return ids.orderBy(F.xxhash64("id"), "id", "label").limit(rows)


def label_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))
