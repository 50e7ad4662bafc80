"""Collocations, token alignment and vantage-point trees against plain programs, and their defined cases."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeloom.llm import collocations, token_alignment, vantage_trees
from storeloom.llm.queries import tokenizer

DOCS = "doc_id long, text string, lang string, phrase string, size int, key long, row long, n long, shard int"


def plain_collocations(docs, support, longest, absorb, top):
    freq, total = {}, Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        own = freq.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            own.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, own in freq.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in cand.items():
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= absorb * a for b in longer):
                continue
            score, _, l, r = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def odd_texts(seed=5, n=120):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "sat", "on", "ÉTÉ", "été", "x y", "a-b", "Iİ", " z", "日本"]
    ends = [" ", "  ", "\t", ". ", ",", ";", "\n", "\r\n", "!", "?", ":", "\x0b", "\x0c", " "] + [" "] * 12
    rows = [(i, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60))), rng.choice(["en", "fr", None, "und"])) for i in range(n)]
    return [*rows, (None, None, "en"), (None, "", None), *rows[:3], (7, "the cat sat " * 400, "en"), (7, "tail! " * 200, None)]


@pytest.mark.parametrize("options", [{}, {"most_bits": 8}, {"max_bytes": 300, "shards": 3}, {"shards": 1}])
def test_collocations_equal_a_plain_count(spark, options):
    docs = odd_texts()
    df = spark.createDataFrame([(*d, "p", 1, 2, 3, 4, 5) for d in docs], DOCS).repartition(3)
    want = plain_collocations(docs, 4, 4, 50, 30)
    assert len({w[0] for w in want}) == 3
    assert sorted(map(tuple, collocations.collocations(df, support=4, longest=4, top=30, **options).collect())) == want


def test_collocations_of_nothing_and_of_few(spark):
    df = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(df.limit(0)).count() == 0
    every = collocations.collocations(df, support=1)  # a b and b c lie in a b c
    assert [tuple(r) for r in every.collect()] == [("en", 1, "a b c", 1, 1, 1, 3, 1_000_000)]


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r, m = 3_000_000_000_000_007, 4_000_000_000_000_037, 4_000_000_000_000_091, 3_500_000_000_000_003
    rows = [("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a), ("en", 1, "z", m), ("en", 2, "y z", a - 9), ("en", 3, "x y z", 1_000_000_000_000_003)]
    out = {x["phrase"]: x for x in collocations.score(spark.createDataFrame(rows, "lang string, size int, phrase string, f long")).collect()}
    assert out["x y"]["score"] == 10**6 * a * a // (l * r)
    three = 1_000_000_000_000_003
    cuts = [10**6 * three**2 // (l * (a - 9)), 10**6 * three**2 // (a * m)]
    assert out["x y z"]["score"] == min(cuts) and out["x y z"]["l"] == (l if cuts[0] <= cuts[1] else a)


def plain_alignment(docs):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_tok, b_tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    a_tok.encode_special_tokens = True
    alphabet = token_alignment.byte_level_alphabet()
    assert len(set(alphabet.values())) == 256
    names = {i: t for t, i in a_tok.get_vocab().items()}
    rows, count = [], Counter()
    for doc, text in docs:
        whole, found, links = (" " + (text or "")).encode(), [], []
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        parts_a = [bytes(alphabet[c] for c in names[i]) for i in a]
        parts_b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_tok.id_to_piece(i)]]
        if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            a, b = [], []
        ends = [{e: k for k, e in enumerate(np.cumsum([len(p) for p in parts]).tolist())} for parts in (parts_a, parts_b)]
        i = j = 0
        for e in sorted(ends[0].keys() & ends[1].keys()) if a else ():
            x, y = ends[0][e] + 1, ends[1][e] + 1
            found.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        count.update(links)
        rows.append((doc, len(a), len(b), links, hashlib.sha256(";".join(found).encode()).hexdigest() if a else ""))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(((d, na, nb, len(l), len(l), sum(count[p] == best[p[1]] for p in l), sum(count[p] for p in l), g) for d, na, nb, l, g in rows), key=str)


TEXTS = ["plain words and more words", "two  spaces,   three", " leading", "trailing ", "tab\tand\nlines \n\n end", "don't we'll I'm", "<|endoftext|> in <s>text</s> <unk>",
         "a▁ b ▁ c", " no break  ", "ctrl\x1c \x1d x\x00y", "emoji 👩‍👩‍👧 é é ́ x", "日本語 のテキスト", "1234567 89,01", "x" * 700, "ﬁ Å ① ㍿", " ", "\n", "  　 x",
         "ab<0x41> A", "tail  next", "é" * 40 + " " + "http://example.org/" + "q1" * 60, None, ""]


@pytest.mark.parametrize("options", [{}, {"hot": 3, "cache_bytes": 1}])
def test_alignment_equals_a_plain_program(spark, options):
    rng = random.Random(2)
    signs = "ab \t\n.'é日 ▁<|>01 \x1c "
    texts = TEXTS + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 40))) for _ in range(200)] + TEXTS[:4] + ["word other third " * 20_000]
    docs = [(None if i % 50 == 9 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*d, "en", "p", 1, 2, 3, 4, 5) for d in docs], "doc_id long, text string, lang string, one string, row long, n_best long, a int, b int, top int").repartition(3)
    out = token_alignment.align(df, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), **options)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == plain_alignment(docs)
    assert token_alignment.align(df.limit(0), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), **options).count() == 0


def usable(v):
    return v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v)


def plain_search(rows, k):
    out = []
    for qid, q in rows:
        if qid is None or qid % 20 or not usable(q):
            continue
        near = sorted((-float(vantage_trees.exact_products(np.array([q], float), np.array([v], float))[0]), i) for i, v in rows if i is not None and i != qid and usable(v) and len(v) == len(q))
        out += [(qid, r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


def vectors(n=1500, seed=4):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, 12)) * rng.uniform(0.2, 3, size=(n, 1))).astype(np.float32)
    x[600:900] = x[600]  # a large group of equal vectors
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    odd = [(2000, None), (2020, [0.0] * 12), (2040, [None] + [1.0] * 11), (2060, [float("nan")] * 12), (2080, [float("inf")] + [1.0] * 11), (None, x[1].tolist()), (2100, []),
           (2120, [1.0, 2.0]), (2121, [2.0, 1.0]), (2122, [-1.0, 0.5]), (2140, [3.0] * 5)]
    return rows + odd + rows[1:4]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 4000}, {"shard_rows": 100, "leaf": 8}])
def test_factor_one_gives_the_exact_neighbours(spark, options):
    rows = vectors()
    df = spark.createDataFrame([(*r, 0, 0.5, 1) for r in rows], "vec_id long, embedding array<float>, rank int, score double, number long").repartition(3)
    got = vantage_trees.search(df, F.col("vec_id") % 20 == 0, k=7, factor=1.0, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_search([(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 7)
    assert vantage_trees.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_a_greater_factor_prunes_and_keeps_most(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(40, 24))
    x = centre[rng.integers(40, size=6000)] + 0.1 * rng.normal(size=(6000, 24))
    ids, q = np.arange(6000), x[::20]
    tree = vantage_trees.Tree.build(x, ids)
    near = np.argsort(-(q @ x.T) + 1e9 * (ids[::20, None] == ids), axis=1, kind="stable")[:, :20]
    shares, recalls = [], []
    for factor in (1.0, vantage_trees.FACTOR, 20.0):
        found = vantage_trees.Search(q, ids[::20], 20, factor)
        found.through(tree)
        shares.append(found.products / (len(q) * len(x)))
        recalls.append(np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found.id, near)]))
    assert recalls[0] == 1.0 and recalls[1] > 0.95 and shares[0] > shares[1] > shares[2] and shares[1] < 0.9


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {(r["query_id"], r["vec_id"]) for r in vantage_trees.search(df, F.col("vec_id") % 20 == 0).collect()}
    want = {(q, i) for q, _, i, _ in plain_search(rows, 20)}
    assert len(got) == len(want) and len(got & want) >= Fraction(9, 10) * len(want)
