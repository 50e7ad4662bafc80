"""Similarity join on word 5-grams: MinHash LSH forest, then exact verification.

A document is its set of shingles: five consecutive words (ASCII letters
lower-cased, punctuation dropped), hashed to 64 bits; one of fewer words, but
not none, has one shingle of all its words. Documents with equal sets form a
copy class, which goes on as one.

Each of ``TREES`` trees gives a class a signature of ``LEVELS`` MinHash values
of 12 bits each, packed into one long. The sorted signatures of a tree are a
prefix trie: a node at depth d is the classes whose first d values agree. The
matched prefix starts at full depth and is shortened until the expected share
of pairs at the threshold that meet in some tree reaches ``RECALL``. Nodes with
the same members in several trees are kept once. Within a node, each pair
counts in the first tree in which it meets, and the Jaccard similarity of its
shingle sets decides. A node of many members is dealt out as pairs of blocks,
so no task holds a whole group; a block pair returns one row a member (its
links and the least member it hangs on), never its pairs.

Groups are connected components over verified links: least labels spread along
the links, with each round written to the shared checkpoint folder. Nothing of
this passes through the driver but the count of labels that still moved.

Scale: texts are shuffled once, to the nodes where their class meets another;
the rest moves hashes. Defined cases: null text and text without words have no
shingles, no links, and are groups of their own; ids may be null or repeat (a
group's id is its least id, null if it has none); repeated rows are copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import free_name, mix, nothing_kept, plain_words, slices, text_digest, texts
from storeloom.session import scratch_folder

WORDS = 5
SIMILARITY = 0.8
TREES, LEVELS, BITS = 20, 5, 12
RECALL = 0.9999
BLOCK = 192
#: A block pair's texts are worked on with at most so many shared shingles at a time.
COLUMNS = 4096
#: Up to so many pairs are compared one by one rather than by a product of incidence matrices.
PAIRWISE = 300


def depth_for(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES, levels: int = LEVELS) -> int:
    """The greatest depth at which pairs at the threshold meet in some tree with the given probability; 1 at least."""
    depth = levels
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def word_hashes(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    """A 64-bit hash of each word."""
    import xxhash
    out = []
    for w in plain_words(text):
        h = known.get(w)
        if h is None:
            h = xxhash.xxh3_64_intdigest(w)
            if len(w) <= 64:  # longer ones seldom repeat, and the cache's bound is a number of words
                known[w] = h
        out.append(h)
    return np.array(out, np.uint64)


def shingles(text: bytes, known: dict[bytes, int], words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if len(known) > 250_000:
        known.clear()
    ids = word_hashes(text, known)
    if not ids.size:
        return ids
    n = max(1, ids.size - words + 1)
    key = np.full(n, min(ids.size, words), np.uint64)
    for j in range(min(words, ids.size)):
        key = mix(key ^ ids[j:j + n])
    return np.unique(key)


class Signer:
    """Packed signatures of shingle sets, one long a tree."""

    def __init__(self, trees: int = TREES, levels: int = LEVELS, seed: int = 5):
        rng = np.random.default_rng(seed)
        k = trees * levels
        self.shape = (trees, levels)
        self.times = rng.integers(0, 1 << 31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, k, dtype=np.uint32)

    def sign(self, keys: np.ndarray) -> np.ndarray:
        short = (keys >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.times.size, 0xFFFFFFFF, np.uint32)
        for at in range(0, short.size, 2048):
            least = np.minimum(least, (short[at:at + 2048, None] * self.times + self.plus).min(axis=0))
        least = (mix(least.astype(np.uint64)) >> np.uint64(64 - BITS)).reshape(self.shape).astype(np.int64)
        out = np.zeros(self.shape[0], np.int64)
        for level in range(self.shape[1]):
            out = (out << BITS) | least[:, level]
        return out


def signed(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Per document: doc_id, text_key (MD5), set_key (of its shingle set; null if empty) and the packed signatures."""
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("doc_id"), text_digest(text).alias("text_key"), text.alias("text"))

    def run(batches):
        import hashlib
        nothing_kept()
        signer, known = Signer(), {}
        for part in slices(batches, "text"):
            keys, signatures = [], []
            for t in texts(part, "text"):
                own = shingles(t, known, words)
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if own.size else None)
                signatures.append(signer.sign(own) if own.size else None)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(keys, pa.binary()), pa.array(signatures, pa.list_(pa.int64()))],
                                             names=["doc_id", "text_key", "set_key", "signature"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_key binary, set_key binary, signature array<long>")


def _pairs(sets: list[np.ndarray], new: np.ndarray, similarity: float) -> np.ndarray:
    """Of the pairs marked in ``new`` (upper triangle), those with Jaccard similarity at the threshold or above."""
    n = len(sets)
    size = np.array([s.size for s in sets], np.int64)
    if int(new.sum()) <= PAIRWISE:
        found = np.zeros((n, n), bool)
        for i, j in zip(*np.nonzero(new), strict=True):
            both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
            found[i, j] = both >= similarity * (size[i] + size[j] - both) - 1e-9
        return found
    row = np.repeat(np.arange(n), size)
    key, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = int(column[-1]) + 1 if column.size else 0
    for at in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        m = np.zeros((n, min(COLUMNS, width - at)), np.float32)
        m[row[lo:hi], column[lo:hi] - at] = 1
        both += m @ m.T
    return new & (both >= similarity * (size[:, None] + size[None, :] - both.astype(np.float64)) - 1e-9)


def verify(rows: list[dict], similarity: float, words: int, shift: int, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """For the members of one node or block pair: each one's weighted links, and the least key that it hangs on.

    Rows have set_key, copies, text, signature, tree, and block_a, block_b (equal within one block) and block.
    """
    n = len(rows)
    prefix = np.array([r["signature"] for r in rows], np.int64) >> shift
    tree = rows[0]["tree"]
    new = np.triu(np.ones((n, n), bool), 1)
    if rows[0]["block_a"] != rows[0]["block_b"]:
        block = np.array([r["block"] for r in rows])
        new &= block[:, None] != block[None, :]
    for t in range(tree):
        new &= prefix[:, t][:, None] != prefix[:, t][None, :]
    links, least = np.zeros(n, np.int64), np.arange(n)
    if not new.any():
        return links, least
    used = np.flatnonzero(new.any(axis=0) | new.any(axis=1))
    sets = [shingles(rows[i]["text"], known, words) for i in used.tolist()]
    found = _pairs(sets, new[np.ix_(used, used)], similarity)
    copies = np.array([rows[i]["copies"] for i in used.tolist()], np.int64)
    links[used] = found @ copies + found.T @ copies
    root = list(range(n))  # union to the least key; rows come sorted by key

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, j in zip(*np.nonzero(found), strict=True):
        a, b = sorted((top(int(used[i])), top(int(used[j]))))
        root[b] = a
    return links, np.array([top(i) for i in range(n)])


def _verified(work: DataFrame, similarity: float, words: int, shift: int) -> DataFrame:
    """Rows of (set_key, links, root_key) from members sorted by node and block pair within a partition."""
    def run(batches):
        held: list[dict] = []
        place, known = None, {}

        def done():
            held.sort(key=lambda r: r["set_key"])
            links, least = verify(held, similarity, words, shift, known)
            keep = np.flatnonzero((links > 0) | (least != np.arange(len(held))))
            return pa.RecordBatch.from_pydict({"set_key": [held[i]["set_key"] for i in keep], "links": links[keep], "root_key": [held[least[i]]["set_key"] for i in keep]},
                                              schema=pa.schema([("set_key", pa.binary()), ("links", pa.int64()), ("root_key", pa.binary())]))
        for part in slices(batches, "text"):
            columns = {c: part.column(c).to_pylist() for c in part.schema.names if c != "text"}
            columns["text"] = texts(part, "text")
            for values in zip(*columns.values(), strict=True):
                row = dict(zip(columns, values, strict=True))
                if (now := (row["tree"], row["prefix"], row["block_a"], row["block_b"])) != place:
                    if len(held) > 1:
                        yield done()
                    held, place = [], now
                held.append(row)
        if len(held) > 1:
            yield done()
    return work.mapInArrow(run, "set_key binary, links long, root_key binary")


def _components(links: DataFrame, root: str) -> DataFrame:
    """(set_key, label): the least key of each connected component over (set_key, root_key) links."""
    spark = links.sparkSession
    pair = links.select(F.col("set_key").alias("u"), F.col("root_key").alias("v")).where("u <> v")
    pair.unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct().write.parquet(f"{root}/edges")
    edges = spark.read.parquet(f"{root}/edges")
    edges.groupBy("u").agg(F.min("v").alias("near")).select("u", F.least("u", "near").alias("label")).write.parquet(f"{root}/labels-0")
    step = 0
    while True:
        now = spark.read.parquet(f"{root}/labels-{step}")
        heard = edges.join(now.select(F.col("u").alias("v"), F.col("label").alias("heard")), "v").groupBy("u").agg(F.min("heard").alias("heard"))
        spread = now.join(heard, "u").select("u", F.col("label").alias("before"), F.least("label", "heard").alias("label"))
        jump = now.select(F.col("u").alias("label"), F.col("label").alias("far"))
        after = spread.join(jump, "label").select("u", F.least("label", "far").alias("label"), (F.least("label", "far") != F.col("before")).alias("moved"))
        step += 1
        after.write.parquet(f"{root}/labels-{step}")
        done = spark.read.parquet(f"{root}/labels-{step}")
        if not done.where("moved").count():
            return done.select(F.col("u").alias("set_key"), "label")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, words: int = WORDS,
            recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per copy class and id: text_key, set_key, doc_id, copies, group_id, n_links, group_key, and what picks a group's document."""
    spark = docs.sparkSession
    root = scratch_folder(spark, "ngram-join")
    signed(docs, id_col, text_col, words).write.parquet(f"{root}/signed")
    base = spark.read.parquet(f"{root}/signed")
    shift = BITS * (LEVELS - depth_for(similarity, recall))

    base.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"), F.min("text_key").alias("text_key"), F.min("signature").alias("signature")).write.parquet(f"{root}/sets")
    sets = spark.read.parquet(f"{root}/sets")
    nodes = sets.select("set_key", F.posexplode("signature").alias("tree", "packed")).select("set_key", "tree", F.shiftright("packed", shift).alias("prefix"))
    met = nodes.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("set_key")).alias("a"), F.bit_xor(F.xxhash64(F.lit(3), "set_key")).alias("b")).where("members > 1")
    once = met.groupBy("members", "a", "b").agg(F.min(F.struct("tree", "prefix")).alias("node")).select("node.tree", "node.prefix", "members")
    joined = nodes.join(once, ["tree", "prefix"])
    blocks = F.ceil(F.col("members") / block).cast("int")
    dealt = (joined.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(F.lit(9), "set_key"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("set_key", "tree", "prefix", "block", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b")))
    dealt.write.parquet(f"{root}/dealt")
    dealt = spark.read.parquet(f"{root}/dealt")
    wanted = sets.join(dealt.select("set_key").distinct(), "set_key", "left_semi").select("set_key", "copies", "text_key", "signature")
    text = F.col(text_col).cast("string")
    body = (docs.select(text_digest(text).alias("text_key"), text.alias("text")).join(wanted, "text_key")
            .groupBy("text_key", "set_key", "copies", "signature").agg(F.first("text").alias("text")).drop("text_key"))
    work = dealt.join(body, "set_key")
    keys = ["tree", "prefix", "block_a", "block_b"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = work.repartition(partitions, *keys).sortWithinPartitions(*keys)
    _verified(work, similarity, words, shift).write.parquet(f"{root}/verified")
    verified = spark.read.parquet(f"{root}/verified")
    label = _components(verified, root)
    count = verified.groupBy("set_key").agg(F.sum("links").alias("links"))

    linked = sets.select("set_key", "copies", "least_id").join(label, "set_key").join(count, "set_key", "left")
    group = linked.groupBy("label").agg(F.min("least_id").alias("group_id"), F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "set_key")).alias("pick"))
    known = linked.join(group, "label").select("set_key", "group_id", "links", F.col("pick.set_key").alias("keeper"))
    every = sets.select("set_key", "copies", "least_id").join(known, "set_key", "left").select(
        "set_key", "copies", F.coalesce("group_id", "least_id").alias("group_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        (F.coalesce("keeper", "set_key") == F.col("set_key")).alias("keeps"), "least_id")
    every.write.parquet(f"{root}/classes")
    return base.select("doc_id", "text_key", "set_key").join(spark.read.parquet(f"{root}/classes"), "set_key", "left")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: doc_id, class_id (the least id of its near-duplicate group) and n_links (other documents at the threshold or above)."""
    return classes(docs, id_col, text_col, **options).select(
        "doc_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("group_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each near-duplicate group, with its own columns: the one with the least id (null last).

    Rows whose set keeps its group and whose id is the least one stay. Where
    several rows share that id, the one with the least text hash stays; rows
    with that text too are numbered, and the first stays.
    """
    own = classes(docs, id_col, text_col, **options)
    stays = own.where(F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("least_id")))
    chosen = stays.groupBy("set_key").agg(F.min("text_key").alias("text_key"), F.count(F.lit(1)).alias("rows"), F.first("doc_id").alias("doc_id"))
    key, who, many = free_name(docs, "text_key"), free_name(docs, "kept_id"), free_name(docs, "same_rows")
    picked = chosen.select(F.col("text_key").alias(key), F.col("doc_id").alias(who), F.col("rows").alias(many))
    src = docs.withColumn(key, text_digest(F.col(f"`{text_col}`").cast("string")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    empty = own.where(F.col("set_key").isNull()).select(F.col("text_key").alias(key)).distinct().withColumn(who, F.lit(None).cast(docs.schema[id_col].dataType)).withColumn(many, F.lit(0))
    found = src.join(picked.unionByName(empty), key).where((F.col(many) == 0) | F.col(f"`{id_col}`").eqNullSafe(F.col(who)))
    alone = found.where(F.col(many) <= 1).select(*columns)
    number = free_name(docs, "row_number")
    from pyspark.sql import Window
    same = found.where(F.col(many) > 1).withColumn(number, F.row_number().over(Window.partitionBy(key, who).orderBy(F.lit(1)))).where(F.col(number) == 1).select(*columns)
    return alone.unionByName(same)
