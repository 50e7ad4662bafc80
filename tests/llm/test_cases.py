"""Defined cases of every operator and stage: nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import pytest

import corpus_pipeline
from storeloom.llm import decontaminate, latent_votes, line_spread, ngram_join, packing, quality_rules, secret_scan, suffix_dedup, token_counts, toxicity
from storeloom.llm.queries import tokenizer

LONG = "word other third " * 20_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, hits string, quality string, digest_key string, clean_text string, text_key string, row_number int"
ROWS = [(1, "some words that say nothing in particular, twice over and over again", "en", "a", 5, 0.1, "h", "q", "d", "c", "t", 1)] * 3 + [
    (None, None, None, None, None, None, None, None, None, None, None, None), (2, "", "en", "a", 0, 0.0, "", "", "", "", "", 0), (2, LONG, "en", None, 1, 0.0, "", "", "", "", "", 0),
    (None, "no id here", None, "b", 3, 0.0, "", "", "", "", "", 0), (3, "\n\n \t", "de", "b", 3, 0.0, "", "", "", "", "", 0)]
VOCABULARY = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("▁w", -1.0)]


@pytest.fixture(scope="module")
def tables(spark):
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0)) for i in range(40)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "some words that say nothing"), (None, None), (2, "")], "item_id long, text string")
    return labels, items


REPORTS = {
    "latent_votes": lambda d, labels, items: latent_votes.report(d, labels),
    "packing": lambda d, labels, items: packing.pack(d, tokenizer("word_bpe_49k.json")),
    "token_counts": lambda d, labels, items: token_counts.count_tokens(d, VOCABULARY),
    "decontaminate": lambda d, labels, items: decontaminate.report(d, items),
    "line_spread": lambda d, labels, items: line_spread.report(d),
    "suffix_dedup": lambda d, labels, items: suffix_dedup.report(d),
    "ngram_join": lambda d, labels, items: ngram_join.report(d),
    "quality_rules": lambda d, labels, items: quality_rules.report(d),
    "toxicity": lambda d, labels, items: toxicity.report(d, labels),
    "secret_scan": lambda d, labels, items: secret_scan.scan_documents(d),
}


@pytest.mark.parametrize("name", REPORTS)
def test_odd_rows(spark, tables, name):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    out = REPORTS[name](docs, *tables).collect()
    if name == "packing":
        assert sum(r["length"] for r in out if r["start"] == 0) and {r["doc_id"] for r in out} == {1, 2, 3, None}
        assert sum(r["start"] == 0 for r in out) == len(ROWS)
    else:
        assert sorted((r["doc_id"] or -1) for r in out) == sorted((r[0] or -1) for r in ROWS)
    same = {tuple(r)[1:] for r in out if r["doc_id"] == 1}
    assert name == "packing" or len(same) == 1  # repeated rows, equal results
    assert REPORTS[name](docs.limit(0), *tables).count() == 0


def test_labels_and_items_may_be_empty(spark, tables):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    labels, items = tables
    for report in (latent_votes.report, toxicity.report):
        assert {r["score"] for r in report(docs, labels.limit(0)).collect()} == {0.0}
    assert not any(r["contaminated"] for r in decontaminate.report(docs, items.limit(0)).collect())


def test_stages_keep_the_columns_and_take_odd_rows(spark, tables, tmp_path):
    labels, items = tables
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        kept = out.collect()
        want = {"near_duplicates": 6, "decontamination": 5}.get(name, len(ROWS))
        assert len(kept) == want, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline_is_its_stages_in_turn(spark):
    sf = "/root/testdata/sf0.001"
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    own = {r["doc_id"]: r["text"] for r in docs.collect()}
    rejected = {r["doc_id"] for r in toxicity.report(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    left = docs.where(~docs.doc_id.isin([*rejected, -1]))
    lines = {r["doc_id"]: r["n_removed"] for r in line_spread.report(left).collect()}
    rows = corpus_pipeline.run(spark, sf).collect()
    kept = {r["doc_id"] for r in rows}
    assert kept and kept <= set(own) - rejected
    cleaned = corpus_pipeline.lines(spark, left, sf)
    assert {r["doc_id"] for r in cleaned.collect() if r["text"] != own[r["doc_id"]]} == {i for i, n in lines.items() if n}
    single = corpus_pipeline.distinct(spark, cleaned, sf)
    clean = decontaminate.report(single, spark.read.parquet(f"{sf}/benchmark.parquet")).where("not contaminated")
    assert kept == {r["doc_id"] for r in clean.collect()}
