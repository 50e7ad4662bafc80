"""The two trained operators: exact gradients, exact voting, held-out accuracy, and labels that stay out of reach."""

import zlib

import numpy as np

from storeloom.llm import latent_votes, toxicity
from storeloom.llm.recurrent import BiGRU

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    one = label == 1
    return (order[one].sum() - one.sum() * (one.sum() + 1) / 2) / one.sum() / (~one).sum()


def test_gradients_match_differences():
    net = BiGRU(hidden=3, word_dim=2, gram_dim=3)
    net.p = {k: v.astype(np.float64) * (3 if k in ("v", "w") else 1) for k, v in net.p.items()}
    words = [b"alpha", b"be", b"gamma", b"d"]
    ids = np.array([[1, 2, 3, 0], [4, 1, 0, 0], [3, 3, 2, 1]])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])
    x = net.inputs(words)[0].astype(np.float64)

    def loss(inputs):
        p = net.forward(ids, net.projected(inputs)).astype(np.float64)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()
    g, dx = net.gradients(ids, x, y, weight)
    rng = np.random.default_rng(0)
    for name in ("W", "U", "b", "v", "w", "c"):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in net.p[name].shape)
            kept, step = net.p[name][at], 1e-2
            values = []
            for sign in (1, -1):
                net.p[name][at] = kept + sign * step
                values.append(loss(x))
            net.p[name][at] = kept
            assert abs((values[0] - values[1]) / (2 * step) - g[name][at]) < 2e-3, name
    for _ in range(8):
        at = (rng.integers(1, 5), rng.integers(0, x.shape[1]))
        values = []
        for sign in (1, -1):
            moved = x.copy()
            moved[at] += sign * 1e-2
            values.append(loss(moved))
        assert abs((values[0] - values[1]) / 2e-2 - dx[at]) < 2e-3


def test_windows_overlap_and_reach_the_end():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        covered = set()
        starts = list(toxicity.window_starts(n))
        for s in starts:
            covered |= set(range(s, min(n, s + toxicity.WINDOW)))
        assert covered == set(range(n))
        assert all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))


def test_training_finds_a_passage_in_the_middle_of_a_long_text(spark):
    import random
    rng = random.Random(2)
    plain = [f"word{k}" for k in range(300)]
    bad = ["vile", "nasty", "scum", "filth", "rotten"]

    def text(n, toxic):
        words = [rng.choice(plain) for _ in range(n)]
        if toxic:
            at = rng.randrange(max(1, n - 10))
            words[at:at + 8] = [rng.choice(bad) for _ in range(8)]
        return " ".join(words)
    long = [rng.choice(plain) for _ in range(20_000)]
    long[9_003:9_011] = [rng.choice(bad) for _ in range(8)]
    rows = [(i, text(40, i % 3 == 0)) for i in range(120)] + [(1000, " ".join(long)), (1001, text(20_000, False)), (1002, text(50, False)), (1002, text(50, False)), (1003, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(1000, 1), (1001, 0), (1002, 0), (1003, 0)], "doc_id long, toxic int")
    labelled = toxicity.sample(docs, labels, "toxic", held_out_of=1 << 30, held_out=0)
    assert labelled.where("id = 1002").count() == 1  # one text an id
    first = toxicity.training_windows(labelled)
    assert not any(set(bad) & {w.decode() for w in own} for i, _, own in first if i == 1000)
    chosen = {}

    def more(net):
        chosen["now"] = toxicity.highest_windows(labelled, net)
        return chosen["now"]
    net = toxicity.train(first, more=more)
    assert {i for i, _, _ in chosen["now"]} == {1000, 1001} and len(chosen["now"]) <= 2 * toxicity.WINDOWS_EACH
    assert any(b"vile" in own or b"scum" in own or b"filth" in own for i, _, own in chosen["now"] if i == 1000)
    scores = toxicity.score_texts(net, [t.encode() for _, t in rows[120:122]])
    assert scores[0] > 0.5 > scores[1]


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id)
    assert auc(got.score.values, got.toxic.values) > 0.9
    assert got[got.toxic == 1].predicted.mean() > 0.8
    assert got[got.toxic == 0].predicted.mean() < 0.03


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = latent_votes.report(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id)
    assert auc(got.score.values, got.quality.values) > 0.97
    assert got[got.quality == 1].predicted.mean() > 0.97


def test_votes_equal_a_plain_search():
    rng = np.random.default_rng(1)
    terms = np.abs(rng.normal(size=(80, 60))).astype(np.float32)
    labels = rng.integers(0, 2, 80)
    model = latent_votes.Votes(terms, labels, dimensions=8)
    own = np.abs(rng.normal(size=(30, 60))).astype(np.float32)
    got = model.score(own, block=7, neighbours=5)
    v = model.project(own)
    for i in range(30):
        cosine = model.vectors @ v[i]
        near = np.argsort(-cosine, kind="stable")[:5]
        weight = np.maximum(cosine[near], 0).astype(float) ** latent_votes.POWER
        assert abs(got[i] - (weight * labels[near]).sum() / weight.sum()) < 1e-5


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2 then 1 - quality else quality end as quality", "toxic")
    a, b = (sorted(map(tuple, latent_votes.report(docs, x).collect())) for x in (labels, turned))
    assert a == b
