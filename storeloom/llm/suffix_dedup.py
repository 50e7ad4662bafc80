"""Suffix-array dedup: removes every byte covered by a long string that starts anywhere else too.

A string is ``LENGTH`` bytes of a text in UTF-8; it is repeated if equal bytes
start at another place, in the same text or another one. All strings are judged
on the input.

1. Cutting. Of every string's ``GRAM``-byte grams the one with the least hash is
   its anchor. Equal strings have equal anchors, so texts are cut into runs of
   string starts with one anchor value, and only runs that share an anchor (or
   meet their own again) can hold repeated strings. The bytes of a run, from its
   first start to the end of its last string, are a piece.
2. Equal pieces of an anchor are counted, not compared: all of their strings are
   repeated, and one of them stands for all. Different pieces of an anchor go to
   a shard.
3. A shard sorts all suffixes of its pieces by Larsson-Sadakane refinement (first
   by 7 bytes, then by the ranks at doubling distances, in numpy, only inside
   groups that are still unsorted), and takes the common prefixes of neighbours
   by Kasai's method, run in many lanes at once. Starts whose neighbours share
   ``LENGTH`` bytes or more are repeated.
4. An anchor with more than ``SHARD_BYTES`` of pieces is dealt over several
   shards. Each hands over sorted fingerprints of its strings, cut by value into
   ranges; a range's task merges them by binary search of each shard's strings
   among the others', which gives the repeats across shards.

Scale: only texts that hold a run with a shared anchor are sent on, their copies
reduced to one row each, and once more to be cleaned. What these filters are made of (shared anchors, equal pieces, ids) is
written first, so Spark broadcasts it where its size is small and joins by
shuffle where it isn't. Shards and ranges are bounded in bytes, so a passage in a
third of all documents is spread over many tasks. Intermediate tables are in the
shared scratch folder. Defined cases: null is empty text and
counts 0 bytes; texts shorter than ``LENGTH`` stay whole; repeated rows repeat
each other; ids may be null or repeat; other columns pass by.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import joined, mix, slices, texts
from storeloom.session import scratch_folder

LENGTH, GRAM = 400, 32
#: Bytes of pieces in a shard, and in all of an anchor before it is dealt over several.
SHARD_BYTES = 3 << 20
#: Ranges of fingerprints to a shard of an anchor that is dealt out.
RANGES = 4

_LOW = np.uint64((1 << 24) - 1)


def anchors(rows: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of string starts: text number, first start, starts, anchor value, whether the anchor stands at several places."""
    data, starts = joined(rows)
    n = len(data)
    pad = np.ndarray(n, "<u8", data + bytes(8), strides=(1,))
    h = mix(np.array(pad))
    span = 8
    while span < gram:  # hash of twice the span, from the hashes of its halves
        far = np.zeros_like(h)
        far[:n - span] = h[span:] if n > span else 0
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + far)
        span *= 2
    # upper bits: the hash; lower bits: the place, so that the first of equal hashes is the least
    least = (h & ~_LOW) | (np.arange(n, dtype=np.uint64) & _LOW)
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:
        least[:n - reach] = np.minimum(least[:n - reach], least[reach:])
        reach *= 2
    if reach < width:
        rest = width - reach
        least[:n - rest] = np.minimum(least[:n - rest], least[rest:])
    counts = np.maximum(np.diff(starts) - length + 1, 0)
    text = np.repeat(np.arange(len(rows)), counts)
    at = np.arange(int(counts.sum())) + np.repeat(starts[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    if not at.size:
        return (np.zeros(0, np.int64),) * 5
    value, place = least[at] >> np.uint64(24), least[at] & _LOW
    first = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (text[1:] != text[:-1]))))
    size = np.diff(np.concatenate((first, [at.size])))
    moved = np.concatenate(([False], place[1:] != place[:-1]))
    moved[first] = False
    several = np.add.reduceat(moved, first) > 0
    return text[first], at[first] - starts[:-1][text[first]], size, value[first].astype(np.int64), several


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order (Larsson-Sadakane: groups that 7, 14, 28... bytes leave unsorted are sorted by the ranks further on)."""
    n = data.size
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    first = np.ndarray(n, ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
    # seven bytes, then how many there are: a suffix that ends comes before one that goes on with zeros
    first = (first & ~np.uint64(255)) | np.minimum(np.arange(n, 0, -1), 8).astype(np.uint64)
    order = np.argsort(first, kind="stable")
    head = np.concatenate(([True], first[order][1:] != first[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    span = 7
    while True:
        ends = np.concatenate((head[1:], [True]))
        open_ = np.flatnonzero(~(head & ends))  # places in groups of two or more
        if not open_.size:
            break
        own = order[open_]
        far = own + span
        beyond = np.where(far < n, rank[np.minimum(far, n - 1)] + 1, 0)
        key = rank[own] * (n + 1) + beyond
        by = np.argsort(key, kind="stable")
        order[open_] = own[by]
        key = key[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        head[open_] |= new
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(new, np.arange(open_.size), 0))]
        span *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int, lane: int = 1024) -> np.ndarray:
    """Kasai: common prefix of each sorted suffix with the one before it, counted up to ``most`` bytes or a little more."""
    n = data.size
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = np.ndarray(n + 1, "<u8", data.tobytes() + bytes(8), strides=(1,))
    out = np.zeros(n, np.int64)
    base = np.arange(0, n, lane)
    have = np.zeros(base.size, np.int64)  # each lane's length so far; it shrinks by one from place to place
    for step in range(lane):
        at = base + step
        live = at < n
        if not live.all():
            base, have, at = base[live], have[live], at[live]
        other = before[at]
        have = np.where(other >= 0, np.maximum(have - 1, 0), 0)
        go = np.flatnonzero((other >= 0) & (have < most))
        while go.size:
            a, b = at[go] + have[go], other[go] + have[go]
            inside = np.maximum(a, b) < n
            go, a, b = go[inside], a[inside], b[inside]
            x = words[a] ^ words[b]
            low = np.log2((x & (~x + np.uint64(1))).astype(np.float64), where=x != 0, out=np.full(x.size, 64.0))
            got = np.minimum((low // 8).astype(np.int64), n - np.maximum(a, b))
            have[go] += got
            go = go[(got == 8) & (have[go] < most)]
        out[at] = have
    return out[order]


def _classes(pieces: list[bytes], starts: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all string starts of the pieces: the piece, the start in it, its class of equal strings; and the pieces' bytes."""
    data, at = joined(pieces)
    flat = np.frombuffer(data, np.uint8)
    order = suffix_array(flat)
    prefix = common_prefixes(flat, order, length)
    group = np.empty(flat.size, np.int64)
    group[order] = np.cumsum(prefix < length)
    count = np.array(starts, np.int64)
    piece = np.repeat(np.arange(count.size), count)
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return piece, place, group[at[:-1][piece] + place], flat


def _runs(text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of consecutive starts (sorted by text and start): text, first start, starts."""
    if not start.size:
        return (np.zeros(0, np.int64),) * 3
    first = np.flatnonzero(np.concatenate(([True], (np.diff(start) != 1) | (np.diff(text) != 0))))
    return text[first], start[first], np.diff(np.concatenate((first, [start.size])))


def fingerprints(flat: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """128-bit fingerprints of the strings at some places: two columns."""
    words = np.ndarray(flat.size, "<u8", flat.tobytes() + bytes(8), strides=(1,))
    out = np.full((at.size, 2), [length, length + 1], np.uint64)
    for j in [*range(0, length - 7, 8), length - 8]:
        out[:, 0] = mix(out[:, 0] ^ words[at + j])
        out[:, 1] = mix(out[:, 1] + words[at + j])
    return out


_SHARD = pa.schema([("id_a", pa.int64()), ("id_b", pa.int64()), ("start", pa.int64()), ("starts", pa.int64()), ("anchor", pa.int64()), ("part", pa.int32()),
                    ("prints", pa.binary()), ("owners", pa.binary()), ("places", pa.binary())])


def _sort_shard(rows: list[dict], length: int) -> list[dict]:
    """Repeated runs of the pieces that stand for one place; for dealt-out anchors the fingerprints to merge."""
    piece, place, group, flat = _classes([r["bytes"] for r in rows], [r["starts"] for r in rows], length)
    times = np.array([r["times"] for r in rows], np.int64)
    total = np.bincount(group, weights=times[piece])
    single = times[piece] == 1
    again = total[group] >= 2
    out = []
    for k, lo, n in zip(*_runs(piece[single & again], place[single & again]), strict=True):
        out.append({"id_a": rows[k]["id_a"], "id_b": rows[k]["id_b"], "start": rows[k]["start"] + int(lo), "starts": int(n)})
    dealt = rows[0]["shards"]
    if dealt > 1:
        offset = np.concatenate(([0], np.cumsum([len(r["bytes"]) for r in rows])))[:-1]
        _, stands = np.unique(group, return_index=True)  # one of each class
        keys = fingerprints(flat, offset[piece[stands]] + place[stands], length)
        wanted = single[stands] & ~again[stands]
        owner = np.array([(r["id_a"], r["id_b"]) for r in rows], np.int64)[piece[stands]]
        owner[~wanted] = 0
        start = np.where(wanted, np.array([r["start"] for r in rows], np.int64)[piece[stands]] + place[stands], -1)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys, owner, start = keys[order], owner[order], start[order]
        parts = dealt * RANGES
        cut = np.searchsorted(keys[:, 0], (np.arange(1, parts, dtype=np.float64) * (2.0 ** 64 / parts)).astype(np.uint64))
        for part, (k, o, s) in enumerate(zip(np.split(keys, cut), np.split(owner, cut), np.split(start, cut), strict=True)):
            if k.size:
                out.append({"anchor": rows[0]["anchor"], "part": part, "prints": k.astype(">u8").tobytes(), "owners": o.tobytes(), "places": s.tobytes()})
    return out


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """Starts that are single in their own shard and found, by binary search, in another one.

    A shard has each of its strings once, so one that stands twice in all shards' strings together is in two of them.
    """
    shards = [(np.frombuffer(p, "S16"), np.frombuffer(o, np.int64).reshape(-1, 2), np.frombuffer(s, np.int64))
              for p, o, s in zip(group["prints"], group["owners"], group["places"], strict=True)]
    merged = np.sort(np.concatenate([keys for keys, _, _ in shards]), kind="stable")  # of sorted parts
    rows = []
    for keys, owner, start in shards:
        wanted = np.flatnonzero(start >= 0)
        after = np.searchsorted(merged, keys[wanted]) + 1
        hit = wanted[(after < merged.size) & (merged[np.minimum(after, merged.size - 1)] == keys[wanted])]
        rows.append(pd.DataFrame({"id_a": owner[hit, 0], "id_b": owner[hit, 1], "start": start[hit]}))
    out = pd.concat(rows, ignore_index=True)
    out["starts"] = 1
    return out.astype({"starts": "int64"})


def cut_spans(marks: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Byte spans covered by strings, from runs (first start, starts)."""
    spans: list[list[int]] = []
    for lo, n in sorted(marks):
        hi = lo + n - 1 + length
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    return [(a, b) for a, b in spans]


def _identity(text) -> list:
    return [F.xxhash64(text).alias("id_a"), F.xxhash64(F.lit(29), text).alias("id_b")]


def removed(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per text (id_a, id_b) with removed bytes: copies, n_removed, spans of bytes, kept text and its SHA-256."""
    spark = docs.sparkSession
    root = scratch_folder(spark, "suffix-dedup")

    def landed(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    text = F.col(text_col).cast("string")
    src = docs.select(text.alias("text")).where(F.octet_length("text") >= length).select(*_identity(F.col("text")), "text")

    def cut(batches):
        for part in slices(batches, "text", 2 << 20):
            rows = texts(part, "text")
            which, start, size, anchor, several = anchors(rows, length, gram)
            kind = [int.from_bytes(hashlib.blake2b(rows[w][s:s + n - 1 + length], digest_size=8).digest(), "little", signed=True)
                    for w, s, n in zip(which.tolist(), start.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id_a").take(pa.array(which)), part.column("id_b").take(pa.array(which)), pa.array(start, pa.int64()), pa.array(size, pa.int32()),
                                              pa.array(anchor, pa.int64()), pa.array(kind, pa.int64()), pa.array(several)],
                                             names=["id_a", "id_b", "start", "starts", "anchor", "kind", "several"])
    runs = landed(src.mapInArrow(cut, "id_a long, id_b long, start long, starts int, anchor long, kind long, several boolean"), "runs")

    shared = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("several").alias("several")).where("n > 1 or several").select("anchor")
    runs = landed(runs.join(landed(shared, "anchors"), "anchor", "left_semi"), "shared")
    kinds = landed(runs.groupBy("anchor", "kind", "starts").agg(F.count(F.lit(1)).alias("times"), F.max("several").alias("several"), F.min(F.struct("id_a", "id_b", "start")).alias("place")), "kinds")
    equal = landed(kinds.where("times > 1").select("anchor", "kind", "starts"), "equal")
    marks = [runs.join(equal, ["anchor", "kind", "starts"], "left_semi").select("id_a", "id_b", "start", F.col("starts").cast("long").alias("starts"))]

    size = F.col("starts").cast("long") + length - 1
    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max(F.col("times") == 1).alias("single"), F.max("several").alias("any"), F.sum(size).alias("total")).where("single and (kinds > 1 or any)").select("anchor", "total")
    sent = (kinds.drop("several").join(landed(mixed, "mixed"), "anchor").withColumn("shards", F.ceil(F.col("total") / shard_bytes).cast("int"))
            .select("place.*", "starts", "anchor", "kind", "times", "shards", F.pmod(F.xxhash64("kind"), F.col("shards")).cast("int").alias("shard")))
    wanted = sent.groupBy("id_a", "id_b").agg(F.collect_list(F.struct("start", "starts", "anchor", "times", "shards", "shard")).alias("pieces"))
    touched = landed(wanted.join(marks[0].select("id_a", "id_b").distinct(), ["id_a", "id_b"], "full_outer"), "touched")
    # one row a text, copies are reduced before the shuffle; only texts that share an anchor go on
    once = src.groupBy("id_a", "id_b").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    once = once.join(landed(touched.select("id_a", "id_b"), "ids"), ["id_a", "id_b"], "left_semi")  # small ids are broadcast below the grouping
    held = landed(once.join(touched, ["id_a", "id_b"]), "texts")

    def pieces(batches):
        names = ["start", "starts", "anchor", "times", "shards", "shard"]
        for part in slices(batches, "text"):
            rows: dict[str, list] = {c: [] for c in ("id_a", "id_b", *names, "bytes")}
            for a, b, body, own in zip(part.column("id_a").to_pylist(), part.column("id_b").to_pylist(), texts(part, "text"), part.column("pieces").to_pylist(), strict=True):
                for p in own:
                    rows["id_a"].append(a)
                    rows["id_b"].append(b)
                    for c in names:
                        rows[c].append(p[c])
                    rows["bytes"].append(body[p["start"]:p["start"] + p["starts"] - 1 + length])
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("id_a", pa.int64()), ("id_b", pa.int64()), ("start", pa.int64()), ("starts", pa.int32()), ("anchor", pa.int64()),
                                                                     ("times", pa.int64()), ("shards", pa.int32()), ("shard", pa.int32()), ("bytes", pa.binary())]))

    def sort(batches):
        own: list[dict] = []
        size, place = 0, None

        def done():
            return pa.RecordBatch.from_pylist(_sort_shard(own, length), schema=_SHARD)
        for part in slices(batches, "bytes"):
            for row in part.to_pylist():
                now = (row["anchor"], row["shard"])
                # a shard ends where an anchor does, once it is full; a dealt-out anchor's shard is one of its own
                if own and now != place and (size >= shard_bytes or row["shards"] > 1 or own[-1]["shards"] > 1):
                    yield done()
                    own, size = [], 0
                place = now
                own.append(row)
                size += len(row["bytes"])
        if own:
            yield done()

    cut_out = held.where(F.col("pieces").isNotNull()).select("id_a", "id_b", "text", "pieces").mapInArrow(
        pieces, "id_a long, id_b long, start long, starts int, anchor long, times long, shards int, shard int, bytes binary")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut_out = cut_out.repartition(partitions, "anchor", "shard").sortWithinPartitions("anchor", "shard")
    found = landed(cut_out.mapInArrow(sort, "id_a long, id_b long, start long, starts long, anchor long, part int, prints binary, owners binary, places binary"), "sorted")
    marks.append(found.where(F.col("prints").isNull()).select("id_a", "id_b", "start", "starts"))
    marks.append(found.where(F.col("prints").isNotNull()).groupBy("anchor", "part").applyInPandas(_merge, "id_a long, id_b long, start long, starts long"))

    every = marks[0].unionByName(marks[1]).unionByName(marks[2]).groupBy("id_a", "id_b").agg(F.collect_set(F.struct("start", "starts")).alias("marks"))

    def clean(batches):
        for part in slices(batches, "text"):
            rows: dict[str, list] = {"id_a": part.column("id_a").to_pylist(), "id_b": part.column("id_b").to_pylist(), "copies": part.column("copies").to_pylist(), "n_removed": [], "spans": [], "kept_sha256": [], "kept": []}
            for body, own in zip(texts(part, "text"), part.column("marks").to_pylist(), strict=True):
                spans = cut_spans([(m["start"], m["starts"]) for m in own], length)
                at, left = 0, []
                for lo, hi in spans:
                    left.append(body[at:lo])
                    at = hi
                kept = b"".join([*left, body[at:]])
                rows["n_removed"].append(len(body) - len(kept))
                rows["spans"].append([{"start": lo, "end": hi} for lo, hi in spans])
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                rows["kept"].append(kept)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("id_a", pa.int64()), ("id_b", pa.int64()), ("copies", pa.int64()), ("n_removed", pa.int64()),
                                                                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.binary())]))
    return held.select("id_a", "id_b", "text", "copies").join(every, ["id_a", "id_b"]).mapInArrow(
        clean, "id_a long, id_b long, copies long, n_removed long, spans array<struct<start long, end long>>, kept_sha256 string, kept binary")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), *_identity(text), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"))
    cut = removed(docs, text_col, **options).select("id_a", "id_b", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
    out = src.join(cut, ["id_a", "id_b"], "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                      F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
