"""Phrase collocations by SON partitioning: complete local mining at lowered support, then exact global counts.

Documents are dealt into ``SHARDS`` equal shards by their ids. A phrase that a
language holds ``support`` times has more than (support - 1) / shards of them in
some shard, however uneven the shards turn out. So every shard is mined completely
at that lowered support, level by level (a phrase can only be frequent if the
phrases without its first and without its last word are); the union of what is
frequent in any shard holds all phrases that are frequent overall. Of the union go
those that can't reach the support with what the other shards may hold below their
own; and one more pass counts all that are left exactly.

A support that doesn't grow with the corpus is lowered to one if there are more
shards than its number, and then prunes nothing; so shards are few and each is
mined by all executors: local counts are sums over (shard, phrase), added up in
each slice first, so a frequent phrase is a row a slice. In mining, phrases
travel as 62-bit hashes; a collision can only add a candidate. What is frequent
reaches the next pass as a bitmap of hashes, whose size has a bound
(``BITMAP_BITS``): beyond it, it lets more phrases pass, never fewer. The last
pass sends the phrases' words and counts them exactly, so neither hashes nor the
bitmap show in results. Scores are whole-number divisions of 38-digit decimals,
exact up to counts of 5 * 10**15.

Defined cases: null text is empty; a null language is ``und``; repeated rows
count each; an empty table gives no rows; a null id is an id like any other. A
text longer than a slice is cut where pieces end, which no phrase crosses.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.llm.common import joined, mix, slices, texts
from storeloom.session import scratch_folder

SUPPORT, LONGEST, ABSORB_PERCENT, TOP = 10, 3, 50, 2000
SHARDS = 4
BITMAP_BITS = 27
SCALE = 1_000_000

#: A-Z to lower case, piece ends to a line feed, tab to space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b for b in range(256))
_WORD = r"[^ \t.,;:!?\n\x0B\f\r]+"
_SHARD_BITS = 2


def _pieces(batch: pa.RecordBatch, max_bytes: int) -> tuple[list[bytes], list[int]]:
    """Texts in plain form, and their rows; a long one in parts that end where pieces end."""
    parts, rows = [], []
    for row, text in enumerate(texts(batch, "text")):
        text = text.translate(_PLAIN)
        at = 0
        while at < len(text) or not at:
            to = len(text)
            if to - at > max_bytes:
                cut = text.rfind(b"\n", at + 1, at + max_bytes)
                cut = text.find(b"\n", at + max_bytes) if cut < 0 else cut
                to = cut if cut >= 0 else to
            parts.append(text[at:to])
            rows.append(row)
            at = max(to, at + 1)
    return parts, rows


class Words:
    """The words of a slice: where each begins and ends, its piece and its row."""

    def __init__(self, parts: list[bytes], rows: np.ndarray):
        data, starts = joined(parts, b"\n")
        self.flat = flat = np.frombuffer(data, np.uint8)
        inside = (flat != 32) & (flat != 10)
        edge = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
        self.begin, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.searchsorted(np.flatnonzero(flat == 10), self.begin)
        self.row = rows[np.searchsorted(starts, self.begin, "right") - 1]

    def hashes(self, row_seed: np.ndarray):
        """Hashes of the phrases of 1, 2, ... words that begin at each word, whether or not their piece goes on."""
        if not self.begin.size:
            return
        own = np.empty(self.begin.size, np.uint64)
        for at in range(0, own.size, _AT_ONCE):  # a polynomial over each word's bytes, by prefix sums of a run of words
            begin, end = self.begin[at:at + _AT_ONCE], self.end[at:at + _AT_ONCE]
            flat = self.flat[begin[0]:end[-1]]
            power = np.full(flat.size + 1, _BASE)
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[flat] * power[:-1], dtype=np.uint64)))
            own[at:at + _AT_ONCE] = (total[end - begin[0]] - total[begin - begin[0]]) * power[flat.size - begin + begin[0]] * _inverse(power[-1])
        own = mix(own)
        value = mix(own + row_seed[self.row])
        while True:
            yield value
            value = mix(value[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[own.size - value.size + 1:])

    def numbers(self, which: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """The numbers of some words in a dictionary of theirs, and that dictionary."""
        begin, size = self.begin[which], (self.end - self.begin)[which]
        offsets = np.concatenate(([0], np.cumsum(size)))
        data = self.flat[np.arange(int(offsets[-1])) + np.repeat(begin - offsets[:-1], size)]
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), begin.size, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        return found.indices.to_numpy().astype(np.int64), found.dictionary

    def whole(self, size: int) -> np.ndarray:
        """Whether a phrase of ``size`` words begins at each word."""
        n = max(0, self.piece.size - size + 1)
        return self.piece[:n] == self.piece[self.piece.size - n:]


#: An odd base, so that its powers have inverses modulo 2 ** 64, and a number for each byte.
_BASE = np.uint64(0xD6E8FEB86659FD93)
_AT_ONCE = 1 << 15
_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _inverse(x: np.uint64) -> np.uint64:
    return np.uint64(pow(int(x), -1, 1 << 64))


def _distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One place and the number of each distinct value, and the place of every value among them."""
    order = np.argsort(code)
    sorted_code = code[order]
    new = np.concatenate(([True], sorted_code[1:] != sorted_code[:-1]))
    rank = np.empty(code.size, np.int64)
    rank[order] = np.cumsum(new) - 1
    return order[new], np.diff(np.concatenate((np.flatnonzero(new), [code.size]))), rank


def _holds(bitmap: tuple[int, np.ndarray], value: np.ndarray) -> np.ndarray:
    bits, words = bitmap
    at = value >> np.uint64(64 - bits)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _seeds(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    import xxhash
    langs = batch.column("lang").to_pylist()
    known = {x: xxhash.xxh3_64_intdigest(x, seed=1) for x in set(langs)}
    return langs, np.array([known[x] for x in langs], np.uint64)


def _local(src: DataFrame, size: int, shorter: tuple[int, object] | None, max_bytes: int) -> DataFrame:
    """(key, n) for the phrases of ``size`` words of each slice: the key's last bits are the shard."""
    def run(batches):
        bitmap = (shorter[0], np.frombuffer(shorter[1].value, np.uint64)) if shorter else None
        low = np.uint64((1 << _SHARD_BITS) - 1)
        for part in slices(batches, "text", max_bytes):
            _, seeds = _seeds(part)
            shard = part.column("shard").to_numpy(zero_copy_only=False).astype(np.uint64)
            parts, rows = _pieces(part, max_bytes)
            for at in _runs(parts, max_bytes):
                words = Words(parts[at], np.array(rows[at]))
                good, value = words.whole(size), None
                if not good.any():
                    continue
                for n, value in enumerate(words.hashes(seeds), 1):
                    if n == size - 1 and bitmap:
                        seen = _holds(bitmap, value)
                        good = good & seen[:-1] & seen[1:]
                    if n == size:
                        break
                key, n = np.unique((value[good] & ~low) | shard[words.row[:good.size][good]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])
    return src.select("lang", "text", "shard").mapInArrow(run, "key long, n long")


def _runs(parts: list[bytes], max_bytes: int) -> list[slice]:
    """Runs of consecutive parts of at most ``max_bytes``, one part at least."""
    out, at, held = [], 0, 0
    for i, p in enumerate(parts):
        if i > at and held + len(p) > max_bytes:
            out.append(slice(at, i))
            at, held = i, 0
        held += len(p)
    return [*out, slice(at, len(parts))] if parts else out


def _bitmap(frequent: DataFrame, most_bits: int) -> tuple[int, bytes]:
    """A bitmap over the leading bits of the keys: about 16 bits a key, at most 2 ** ``most_bits`` in all."""
    n = frequent.count()
    bits = min(max(16, (16 * n).bit_length()), most_bits)
    at = F.shiftrightunsigned("key", 64 - bits)
    got = (frequent.groupBy(F.shiftrightunsigned(at, 6).cast("int").alias("i")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")).alias("w"))).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[got.column("i").to_numpy()] = got.column("w").to_numpy().view(np.uint64)
    return bits, words.tobytes()


def _exact(src: DataFrame, bitmaps: list[tuple[int, object]], max_bytes: int) -> DataFrame:
    """(lang, size, phrase, n) of each slice for the phrases that the bitmaps hold, by their words."""
    def run(batches):
        maps = [(bits, np.frombuffer(b.value, np.uint64)) for bits, b in bitmaps]
        for part in slices(batches, "text", max_bytes):
            langs, seeds = _seeds(part)
            names = sorted(set(langs))
            place = {x: i for i, x in enumerate(names)}
            numbers = np.array([place[x] for x in langs], np.int64)
            parts, rows = _pieces(part, max_bytes)
            for at in _runs(parts, max_bytes):
                words = Words(parts[at], np.array(rows[at]))
                alive, code = np.arange(words.begin.size), None
                for size, (value, bitmap) in enumerate(zip(words.hashes(seeds), maps, strict=False), 1):
                    alive = alive[alive + size <= words.begin.size]
                    alive = alive[words.whole(size)[alive] & _holds(bitmap, value[alive])]
                    if not alive.size:
                        break
                    if size == 1:
                        number, dictionary = words.numbers(alive)
                        place_of = np.full(words.begin.size, -1)
                        place_of[alive] = number
                        code = np.full(words.begin.size, -1)
                        code[alive] = numbers[words.row[alive]] * len(dictionary) + number
                    else:  # exact numbers of longer phrases: of the shorter ones, brought close, and the next word's
                        alive = alive[place_of[alive + size - 1] >= 0]
                        if not alive.size:
                            break
                        code[alive] = rank_of[alive] * len(dictionary) + place_of[alive + size - 1]
                    first, n, rank = _distinct(code[alive])
                    rank_of = np.zeros(words.begin.size, np.int64)
                    rank_of[alive] = rank
                    first = alive[first]
                    own = [dictionary.take(pa.array(place_of[first + k])) for k in range(size)]
                    phrase = pc.binary_join_element_wise(*own, pa.scalar(b" ", pa.large_binary())) if size > 1 else own[0]
                    lang = pa.array(names, pa.string()).take(pa.array(numbers[words.row[first]]))
                    yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(first.size, size, np.int32)), phrase.view(pa.large_string()).cast(pa.string()), pa.array(n.astype(np.int64))],
                                                     names=["lang", "size", "phrase", "n"])
    return src.select("lang", "text").mapInArrow(run, "lang string, size int, phrase string, n long")


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", most_bits: int = BITMAP_BITS, max_bytes: int = 4 << 20) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of 1 to ``longest`` words with f >= ``support``; (lang, n) with all words' number."""
    if not 1 <= shards <= 1 << _SHARD_BITS:
        raise ValueError(f"1 to {1 << _SHARD_BITS} shards")
    spark = docs.sparkSession
    root = scratch_folder(spark, "collocations")
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      F.pmod(F.xxhash64(F.col(id_col)), F.lit(shards)).cast("int").alias("shard"))
    sizes = src.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(_WORD)).cast("long")).alias("n"))
    least = (support - 1) // shards + 1
    maps: list[tuple[int, object]] = []
    for size in range(1, longest + 1):
        found = _local(src, size, maps[-1] if maps else None, max_bytes).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        union = found.groupBy(F.shiftrightunsigned("key", _SHARD_BITS).alias("key")).agg(F.sum("n").alias("n"), F.count("*").alias("met"))
        may = F.col("n") + (shards - F.col("met")) * (least - 1) >= support
        union.where(may).select(F.shiftleft("key", _SHARD_BITS).alias("key")).write.parquet(f"{root}/mined-{size}")
        bits, bitmap = _bitmap(spark.read.parquet(f"{root}/mined-{size}"), most_bits)
        maps.append((bits, spark.sparkContext.broadcast(bitmap)))
    counted = _exact(src, maps, max_bytes).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    counted.write.parquet(f"{root}/counted")
    for _, b in maps:
        b.unpersist()
    return spark.read.parquet(f"{root}/counted"), sizes


def _joined(words: Column, begin: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, begin, n), " ")


def _whole_div(a: Column, l: Column, r: Column) -> Column:
    """floor(SCALE * a * a / (l * r)), exactly."""
    big = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * big(a) * big(a), big(l) * big(r))


def score(phrases: DataFrame, absorb_percent: int = ABSORB_PERCENT, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more that no longer one takes in."""
    words = F.split("phrase", " ")
    many = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))
    cuts = many.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _joined(F.col("w"), F.lit(1), F.col("k")).alias("left"), _joined(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    part = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    least = F.min(F.struct(_whole_div(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(least.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    inner = many.where("size > 2").select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n")).select(
        "lang", "a", "w", "n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("i")).select("lang", "a", _joined(F.col("w"), F.col("i"), F.col("n")).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(absorb_percent) * F.col("a"))
    return scored.join(inner, ["lang", "phrase"], "left").where(kept).drop("longer")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, absorb_percent: int = ABSORB_PERCENT, top: int = TOP, **options) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    phrases, sizes = frequent_phrases(docs, support, longest, **options)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = score(phrases, absorb_percent, longest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
