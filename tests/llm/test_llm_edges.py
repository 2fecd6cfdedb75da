"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns
with clashing names: defined results, no failures."""

import hashlib

import pytest
from pyspark.sql import functions as F

from aerolytics.llm import (decontaminate, html_extract, line_dedup, ngram_join, packing, quality, secrets,
                            token_counts, toxicity, url_filter)
from aerolytics.llm.queries import split_pattern, vocabulary
from tests.llm.llm_data import documents, edge_rows, empty

RANKS, WORDS = vocabulary("byte_bpe_50k.tiktoken"), vocabulary("word_bpe_49k.json")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def operators(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (4, None), (12, 1), (9, 0)],
                                   "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6"), (2, None), (3, ""), (None, "one two three")],
                                  "item_id long, text string")
    return {
        "secrets": lambda d: secrets.find_secrets(d, RANKS, split_pattern()),
        "leaks": lambda d: decontaminate.find_leaks(d, bench),
        "counts": lambda d: token_counts.length_histogram(token_counts.token_lengths(d, RANKS, split_pattern())),
        "lines": lambda d: line_dedup.find_duplicate_lines(line_dedup.row_keys(d, "doc_id")),
        "toxicity": lambda d: toxicity.score_documents(d, toxicity.fit(d, labels)),
        "ngrams": lambda d: ngram_join.link_components(d),
        "packing": lambda d: packing.pack_documents(d, WORDS, sequence_tokens=256, buffer_tokens=4096),
        "quality": lambda d: quality.quality_filter(d),
    }


ONE_PER_ROW = {"secrets", "toxicity", "ngrams", "quality"}


@pytest.mark.parametrize("name", ["secrets", "leaks", "counts", "lines", "toxicity", "ngrams", "packing", "quality"])
def test_edges(spark, name):
    op = operators(spark)[name]
    none = op(empty(spark))
    assert none.count() == 0
    plain, clash = documents(spark, edge_rows()), documents(spark, edge_rows(), clashes=True)
    a, b = op(plain), op(clash)
    assert a.columns == none.columns == b.columns
    if name == "lines":                                  # rows with one id are told apart by a number
        a, b = a.drop("row"), b.drop("row")
    if name in ONE_PER_ROW:
        assert a.count() == len(edge_rows())
    if name not in ("packing", "toxicity"):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    else:
        assert a.count() == b.count()


def test_secrets_values(spark):
    d = documents(spark, [(1, None, "", ""), (2, "", "", ""), (3, "é token=abcdef x", "", "")])
    out = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(d, RANKS, split_pattern()).collect()}
    assert out[1] == [] and out[2] == []
    assert [tuple(s) for s in out[3]] == [("assign", 2, 14)]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_links_of_edge_rows(spark):
    out = ngram_join.link_components(documents(spark, edge_rows()))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=repr)
    by = {}
    for i, n, c in got:
        by.setdefault(i, []).append((n, c))
    assert by[2] == [(76, 1), (76, 1)] and by[12] == [(78, 1)]
    assert by[3] == [(0, 3)] and by[4] == [(0, 4)] and by[5] == [(0, 5)]
    assert by[6] == [(1, 6)] and by[7] == [(1, 7)] and by[8] == [(1, 7)]
    assert sorted(by[None], key=repr) == [(0, None), (77, 1)]
    assert by[11] == [(1, 11)]


def test_quality_of_edge_rows(spark):
    out = {r["doc_id"]: r for r in quality.quality_filter(documents(spark, edge_rows())).collect()}
    assert out[3]["n_words"] == 0 and out[3]["base_failed"] and not out[3]["kept"]
    assert out[5]["n_words"] == 0 and out[5]["word_chars"] == 0
    assert out[11]["n_words"] == 10 and out[11]["n_repeat_words"] == 10
    assert out[10]["n_words"] == 1 and out[10]["word_chars"] == 200_000
    assert out[1]["kept"]


def test_pages_edges(spark):
    d = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<p>a", "x"), (2, "u", "<p>a", "x")],
                              "page_id long, url string, html string, text string")
    out = html_extract.extract_main_text(d)
    assert rows(out, "page_id", "url", "text") == sorted(
        [(1, None, ""), (None, "u", ""), (2, "u", "a"), (2, "u", "a")], key=repr)
    assert html_extract.extract_main_text(d.limit(0)).count() == 0
    model = url_filter.train(url_filter.LABELLED_URLS)
    urls = spark.createDataFrame([(1, None, "h"), (None, "no scheme", "h"), (2, "http://A.NET", "h"),
                                  (3, "ftp://a.b.net/x?y", "h")], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in url_filter.judge_urls(urls, model, url_filter.RULES).collect()}
    assert got[1][:3] == ("", "", None) and got[None][:3] == ("", "", None)
    assert got[2][:3] == ("a.net", "", None) and got[3] == ("a.b.net", "/x", "net/", "block")
    assert url_filter.judge_urls(urls.limit(0), model, url_filter.RULES).count() == 0


def test_pipeline_edges(spark, tmp_path):
    import corpus_pipeline
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "q1 q2 q3 q4 q5 q6 q7")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for d in (empty(spark), documents(spark, edge_rows(), clashes=True)):
        path = str(tmp_path / f"d{len(d.columns)}.parquet")
        d.write.mode("overwrite").parquet(path)
        x = spark.read.parquet(path)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            y = stage(spark, x, str(tmp_path))
            assert y.columns == x.columns and y.schema == x.schema, name
            y.write.parquet(str(tmp_path / f"{name}{len(d.columns)}"))
            x = spark.read.parquet(str(tmp_path / f"{name}{len(d.columns)}"))
        corpus_pipeline.STAGES[-1][1](spark, x, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in x.select("doc_id").collect()}
    assert {1, 3, 4, 5, 6, 9, 10, 11, 13} <= ids and 2 not in ids
    assert x.where(F.col("doc_id").isNull()).count() >= 1
