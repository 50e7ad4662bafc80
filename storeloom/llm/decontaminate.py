"""Benchmark decontamination by Wu-Manber multi-pattern search.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A test
string is a window of 13 consecutive words of a benchmark item, written with
one space between words and one at either end; an item of fewer words, but
not none, is one test string. A document is written the same way, so an
occurrence of a test string is an occurrence of a window of words.

The search compares the last ``B`` bytes at the current position with a shift
table over all blocks of all test strings: a non-zero shift skips positions at
which no string can end; at shift zero, the block's bucket gives the strings
that have it as their suffix (over the shortest length), and direct comparison
confirms the occurrence. Thousands of positions of a slice of documents advance
at once as numpy lanes. Test strings are put in length classes with tables of
their own, so that a one-word item does not shorten the shifts of the others.

Scale: with a benchmark of at most ``block_bytes``, counted before, documents are
only read and mapped; nothing is shuffled. A larger one is landed, its distinct
test strings are numbered and broadcast in blocks of about that size, one at a
time: each pass writes the hits of its block (text digest, spans, numbers) to the
shared scratch folder before the next block is fetched. Numbers are joined to item
ids on Spark, and hits to documents by text digest.

Defined cases: null or empty text has no words and is clean; items that are
null or have no words give no test string; repeated items and windows that
several items share count for each distinct item id; a null item id marks
words as hit but is not among the items. Other columns pass through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.common import append, free_name, joined, nothing_kept, plain_text, plain_words, slices, text_digest, texts
from storeloom.session import scratch_folder

WINDOW_WORDS = 13
BLOCK_BYTES = 32 << 20
#: Lengths (bytes) at which a further class of test strings begins.
LENGTH_CLASSES = (1, 8, 24, 56)

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


class WuManber:
    """Shift table and suffix buckets over byte strings of nearby lengths."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = min(map(len, patterns))
        self.block = min(8, self.m) if self.m >= 16 else min(3, self.m)
        bits = min(24, max(10, math.ceil(math.log2(4 * len(patterns) * self.m))))
        self.down = np.uint64(64 - bits)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        heads = np.frombuffer(b"".join(p[: self.m] + bytes(8) for p in patterns), np.uint8)
        rows = np.ndarray((len(patterns), self.m), "<u8", heads, strides=(self.m + 8, 1))
        last = self.m - self.block
        self.shift = np.full(1 << bits, last + 1, np.int32)
        for j in range(last + 1):
            np.minimum.at(self.shift, self._hash(rows[:, j]), last - j)
        suffix = self._hash(rows[:, last])
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        self.prefix = np.array(rows[:, 0][self.order]) & self.mask

    def _hash(self, block: np.ndarray) -> np.ndarray:
        return (((block & self.mask) * np.uint64(0x9E3779B97F4A7C15)) >> self.down).astype(np.int64)

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(pattern number, offset) of every occurrence."""
        n, m, b = len(text), self.m, self.block
        if n < m:
            return
        words = np.ndarray(n, "<u8", text + bytes(8), strides=(1,))
        lane = 2048
        at = np.arange(m, n + 1, lane, dtype=np.int64)  # ends of the shortest length
        end = np.minimum(at + lane, n + 1)
        found = []
        while at.size:
            block = self._hash(words[at - b])
            step = self.shift[block]
            hit = step == 0
            if hit.any():
                found.append((at[hit] - m, block[hit]))
            at = at + np.maximum(step, 1)
            live = at < end
            if not live.all():
                at, end = at[live], end[live]
        if not found:
            return
        start = np.concatenate([f[0] for f in found])
        block = np.concatenate([f[1] for f in found])
        lo, hi = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        for depth in range(int((hi - lo).max()) if lo.size else 0):
            more = lo + depth < hi
            pick, place = (lo + depth)[more], start[more]
            same = (words[place] & self.mask) == self.prefix[pick]
            for k, p in zip(self.order[pick[same]].tolist(), place[same].tolist(), strict=True):
                s = self.patterns[k]
                if text.startswith(s, p):
                    yield k, p


def windows(items: DataFrame, text_col: str, id_col: str, size: int) -> DataFrame:
    """Distinct (window, item): the test strings of the items; ``item`` is the id as text."""
    def cut(batches):
        for part in slices(batches, "text"):
            got: set[tuple[str, str | None]] = set()
            for text, item in zip(texts(part, "text"), part.column("item").to_pylist(), strict=True):
                words = plain_words(text)
                for i in range(max(min(len(words), 1), len(words) - size + 1)):
                    got.add(((b" " + b" ".join(words[i:i + size]) + b" ").decode(), item))
            pairs = sorted(got, key=str)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
                                             names=["window", "item"])
    src = items.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("string").alias("item"))
    return src.mapInArrow(cut, "window string, item string").distinct()


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", item_id: str = "item_id",
              size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with one more struct column, and its name: n_words, hit spans (in words), sorted items found."""
    spark = docs.sparkSession
    found = windows(items, item_text, item_id, size)
    bytes_of = F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16
    total = found.agg(F.coalesce(F.sum(bytes_of), F.lit(0))).first()[0]
    name = free_name(docs, "hits")
    if total > block_bytes:
        return _in_blocks(docs, found, text_col, name, block_bytes), name
    rows = found.groupBy("window").agg(F.collect_set("item").alias("items")).toLocalIterator()
    strings = [(r["window"].encode(), sorted(r["items"])) for r in rows]
    return _pass(docs, spark.sparkContext.broadcast(sorted(strings)), text_col, name, first=True), name


def _in_blocks(docs: DataFrame, found: DataFrame, text_col: str, name: str, block_bytes: int) -> DataFrame:
    """``docs`` with the hits of a benchmark that is more than one block."""
    spark = docs.sparkSession
    root = scratch_folder(spark, "decontamination")
    found.write.parquet(f"{root}/windows")
    found = spark.read.parquet(f"{root}/windows")
    found.select("window").distinct().withColumn("number", F.monotonically_increasing_id()).write.parquet(f"{root}/numbers")
    numbers = spark.read.parquet(f"{root}/numbers")
    total = numbers.agg(F.sum(F.octet_length("window") + 16)).first()[0]
    blocks = max(1, math.ceil(1.25 * total / block_bytes))
    text = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    for k in range(blocks):
        mine = numbers.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        strings = spark.sparkContext.broadcast(sorted((r["window"].encode(), [r["number"]]) for r in mine.toLocalIterator()))
        hits = _pass(text, strings, "text", "hits", first=True, item="long").where(F.size("hits.spans") > 0)
        hits.select(text_digest(F.col("text")).alias("digest"), "hits.spans", "hits.items").write.parquet(f"{root}/hits/block={k}")
        strings.destroy()
    hits = spark.read.parquet(f"{root}/hits")
    spans = hits.select("digest", F.explode("spans").alias("span")).groupBy("digest").agg(F.collect_set("span").alias("spans"))
    items = (hits.select("digest", F.explode("items").alias("number")).distinct()
             .join(numbers.join(found, "window").select("number", "item"), "number").groupBy("digest").agg(F.sort_array(F.collect_set("item")).alias("items")))
    key, every = free_name(docs, "text_digest"), spans.join(items, "digest")
    every = every.select(F.col("digest").alias(key), F.struct(F.lit(0).cast("long").alias("n_words"), "spans", "items").alias(name))
    whole = docs.withColumn(key, text_digest(F.col(f"`{text_col}`").cast("string"))).join(every, key, "left").drop(key)
    none = F.from_json(F.lit('{"n_words": 0, "spans": [], "items": []}'), HITS)
    whole = whole.withColumn(name, F.coalesce(F.col(name).cast(HITS), none))
    return _pass(whole, spark.sparkContext.broadcast([]), text_col, name, first=False)


def _pass(docs: DataFrame, strings, text_col: str, name: str, first: bool, item: str = "string") -> DataFrame:
    """One pass over the documents with one block of test strings; not the first one: what column ``name`` has is taken in."""
    arrow_item, hits = (pa.string(), HITS) if item == "string" else (pa.int64(), T.StructType([*HITS.fields[:2], T.StructField("items", T.ArrayType(T.LongType()))]))

    def run(batches):
        nothing_kept()
        classes = []
        for low, high in zip(LENGTH_CLASSES, (*LENGTH_CLASSES[1:], 1 << 62), strict=True):
            if own := [(s, i) for s, i in strings.value if low <= len(s) < high]:
                classes.append((WuManber([s for s, _ in own]), [i for _, i in own], [s.count(b" ") - 1 for s, _ in own]))
        for part in slices(batches, text_col):
            plain = [plain_text(t) for t in texts(part, text_col)]
            before = None if first else part.column(name).to_pylist()
            buffer, starts = joined(plain, b"\n")
            spans: list[list[tuple[int, int]]] = [[] for _ in plain]
            items: list[set[str]] = [set() for _ in plain]
            for tables, ids, lengths in classes:
                for k, place in tables.find(buffer):
                    row = int(np.searchsorted(starts, place, "right")) - 1
                    spans[row].append((place - int(starts[row]), lengths[k]))
                    items[row].update(ids[k])
            rows = []
            for r, text in enumerate(plain):
                flat = np.frombuffer(text, np.uint8) if spans[r] else None
                word_at = np.cumsum(flat == 32) - 1 if spans[r] else None
                own = [(int(word_at[p]), int(word_at[p]) + n) for p, n in set(spans[r])]
                if before is not None:
                    own += [(s["start"], s["end"]) for s in before[r]["spans"]]
                    items[r].update(before[r]["items"])
                merged: list[list[int]] = []
                for s, e in sorted(own):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                rows.append({"n_words": max(0, text.count(b" ") - 1), "spans": [{"start": s, "end": e} for s, e in merged],
                             "items": sorted(items[r])})
            kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(arrow_item))])
            if not first:
                part = part.drop_columns([name])
            yield append(part, **{name: pa.array(rows, kind)})

    base = [f for f in docs.schema.fields if f.name != name]
    return docs.mapInArrow(run, T.StructType([*base, T.StructField(name, hits)]))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found, name = find_hits(src, items, **options)
    h = F.col(name)
    n_hit = F.aggregate(h["spans"], F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", h["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(h["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(h["items"], ",").cast("binary"), 256).alias("items_sha256"),
                        contaminated(h).alias("contaminated"))


def contaminated(hits, share: int = 20):
    """The contract's rule: some word is hit, and at least one in ``share``."""
    n_hit = F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (n_hit > 0) & (share * n_hit >= hits["n_words"])


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found, name = find_hits(docs, items, text_col=text_col, **options)
    return found.where(~contaminated(F.col(name))).select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(values: list[str]) -> str:
    """Lowercase hex SHA-256 of the values, comma-joined."""
    return hashlib.sha256(",".join(values).encode()).hexdigest()
