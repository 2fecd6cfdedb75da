"""Ids, tokens and seeds that earlier rounds had wrong: fuzz, joined words, unseen hosts."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from aerolytics.llm import packing, toxicity, url_filter
from aerolytics.llm import queries as Q
from tests.conftest import SF01
from tests.llm.llm_data import documents

WORDS = Q.vocabulary("word_bpe_49k.json")


def test_op9_ids_of_fuzzed_texts_equal_the_tokenizer():
    """10,000 texts of letters that change under normalisation, marks, stops and blanks."""
    rnd = random.Random(8)
    odd = packing.unsettled_letters()
    assert "İ" in odd and "क़" in odd and "e" not in odd and "é" not in odd
    alphabet = ["a", "b", "Z", "é", "É", "ß", "İ", "i", "̇", "́", ".", ",", " ", " ", "\n", "\t", "'s", "1",
                "<|endoftext|>", "漢", "ẞ", "יִ", "ǆ", "Å", "\U0001f600", *odd[::9]]
    texts = ["İ. x", "क़, y", "a. b, c"] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 14))) for _ in range(10_000)]
    enc = packing.WordEncoder.get(WORDS)
    want = enc.tok.encode_batch_fast(texts, add_special_tokens=False)
    for lo in range(0, len(texts), 500):
        ids, cuts = enc.encode(pa.array(texts[lo:lo + 500]))
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            assert ids[a:b].tolist() == want[lo + i].ids, texts[lo + i]


def test_op6_pieces_cover_every_character():
    rnd = random.Random(2)
    for _ in range(2000):
        w = "".join(rnd.choice("ab,.;-'’_é漢!1") for _ in range(rnd.randrange(1, 80)))
        parts = toxicity.pieces(w)
        assert "".join(parts) == w and all(0 < len(p) <= toxicity.LONGEST for p in parts)
    assert toxicity.pieces("don't") == ["don't"] and toxicity.pieces("(end).") == ["(end)."]
    assert toxicity.pieces("a,bad-word") == ["a,", "bad-", "word"]
    assert [(a, s) for a, s in toxicity.tokens("x,y  z")] == [(0, "x,"), (2, "y"), (5, "z")]


def test_op6_joined_and_long_words_reach_the_score(spark):
    """Held-out toxic documents whose words are joined by commas are caught as before."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model = toxicity.fit(docs, labels)
    held = (docs.join(labels, "doc_id").where(toxicity.fold(docs["doc_id"]) == 0).select("doc_id", "text", "toxic").collect())
    toxic = [(r["doc_id"], ",".join(r["text"].split())) for r in held if r["toxic"] == 1]
    clean = [(r["doc_id"], ",".join(r["text"].split())) for r in held if r["toxic"] == 0]
    d = documents(spark, [(i, t, "en", "a") for i, t in toxic + clean])
    got = {r["doc_id"]: r for r in toxicity.score_documents(d, model).collect()}
    assert len(toxic) >= 3 and all(got[i]["predicted"] == 1 for i, _ in toxic)
    assert np.mean([got[i]["predicted"] for i, _ in clean]) <= 0.05
    text = dict(toxic)
    for i, _ in toxic:
        assert got[i]["spans"] and all(0 <= s["start"] < s["end"] <= len(text[i]) for s in got[i]["spans"])


def test_op7_seed_is_free_of_given_hosts_and_judges_unseen_ones():
    model = url_filter.train(url_filter.LABELLED_URLS)
    seeds = {url_filter.split_url(u)[0] for u, _ in url_filter.LABELLED_URLS}
    given = {url_filter.split_url(u)[0] for u in pq.read_table(f"{SF01}/pages.parquet")["url"].to_pylist()}
    assert not (seeds & given) - {""}
    unseen = [("https://stanford.edu/admissions", 0), ("https://gitlab.com/x/y", 0), ("https://openstreetmap.org/way/1", 0),
              ("https://www.reuters.com/world", 0), ("https://www.heise.de/news", 0), ("https://cran.r-project.org/web", 0),
              ("https://kernel.org/doc", 0), ("https://www.loc.gov/item/2", 0), ("https://github.com/a/b", 0), ("", 0), (None, 0),
              ("https://royal-casino-vip.example.com/spin", 1), ("http://online-pokerbonus.example.net/x", 1),
              ("https://viagrapills24.org/buy", 1), ("http://xxxcams-live.com/", 1), ("https://paydayloans-now.example.com/apply", 1),
              ("http://farmbacklinks.example.org/x", 1), ("https://crackkeygens.example.net/d", 1), ("http://popup-clicks.com/b", 1)]
    right = [(url_filter.score(model, *url_filter.split_url(u)) >= 0.5) == bool(y) for u, y in unseen]
    assert sum(right) >= len(right) - 1


def test_op7_long_urls_and_equal_rules(spark):
    url = "http://a.b.example.com/" + "x" * 200_000 + "?q#f"
    pages = spark.createDataFrame([(1, url), (1, url), (2, "http://example.com/de")], "page_id long, url string")
    rules = [("example.com/", "block"), ("b.example.com/", "allow"), ("example.com/de", "allow")]
    got = url_filter.judge_urls(pages, url_filter.train(url_filter.LABELLED_URLS), rules).collect()
    assert sorted((r["page_id"], len(r["path"]), r["rule"], r["verdict"]) for r in got) == [
        (1, 200_001, "b.example.com/", "allow")] * 2 + [(2, 3, "example.com/de", "allow")]


def test_pipeline_decides_by_row(spark, tmp_path):
    """Rows with null or shared ids: leaks and copies go, clean rows with the same id stay."""
    import corpus_pipeline as cp
    rnd = random.Random(3)
    item = " ".join(f"q{i}" for i in range(30))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(60)) for _ in range(5)]
    leak = f"{text[3]} {item} {text[4]}"
    rows = [(7, text[0]), (7, leak), (None, leak + " end"), (None, text[1]), (3, text[1] + " more"), (None, text[1]), (9, text[2]),
            (9, text[2]), (None, None), (None, None)]
    d = documents(spark, [(i, t, "en", "a") for i, t in rows])
    near = cp.drop_near_duplicates(spark, d, str(tmp_path))
    assert near.columns == d.columns
    got = sorted(((r["doc_id"], r["text"]) for r in near.collect()), key=repr)
    assert sum(t == text[2] for _, t in got) == 1 and (7, leak) in got and (3, text[1] + " more") in got
    assert not any(t == text[1] for _, t in got) and sum(t is None for _, t in got) == 2
    out = sorted(((r["doc_id"], r["text"]) for r in cp.drop_benchmark_leaks(spark, d, str(tmp_path)).collect()), key=repr)
    assert out == sorted(((i, t) for i, t in rows if t is None or item not in t), key=repr)


def test_a_released_table_leaves_no_shuffle(spark):
    """The shuffles behind a released table are gone when it is written, without the driver's garbage collection."""
    from aerolytics.llm import common
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()

    def kept():
        return held.shuffleStatuses().size()

    spark.conf.set("spark.sql.adaptive.enabled", "true")
    before, setting = kept(), spark.conf.get(common.CLEANUP, "false")
    t = common.scratch(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().repartition(3), "released", release=True)
    assert kept() <= before and t.count() == 10 and spark.conf.get(common.CLEANUP, "false") == setting


def test_op9_words_with_signs_behind_them_are_encoded_once():
    """Runs of signs behind a word do not make new chunks; the ids stay those of the whole text."""
    e = packing.WordEncoder(Q.vocabulary("word_bpe_49k.json"))
    plain, sent = e.tok, []

    class Counted:
        def encode_batch_fast(self, texts, **more):
            sent.extend(texts)
            return plain.encode_batch_fast(texts, **more)

    e.tok = Counted()
    signs = ["%%%", "$$$", "...", ".%%%", ")", "?!", ":", "\"", "]", "_", "\\", "-", "'", "'s.", "<", "|", ">", "é;", "́.", "İ!"]
    texts = [" ".join(w + s for w in ("harbour", "Été", "x1") for s in signs) + " end%", "wörd." , "a% b"]
    flat, cuts = e.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(t.startswith("harbour") and not set(t) & set("'<|>") for t in sent) <= 4


def test_op4_pairs_verified_by_parts_are_the_same(spark, monkeypatch):
    from aerolytics.llm import line_dedup
    r = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    texts = ["\n".join(" ".join(r.sample(words, 9)) for _ in range(4)) for _ in range(30)]
    texts += [t.replace(r.choice(words), "other") for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("__row", F.col("doc_id"))

    def gone():
        return sorted((x["doc_id"], x["line_no"]) for x in line_dedup.find_duplicate_lines(docs).collect())

    want, tables, plain = gone(), [], line_dedup.scratch
    monkeypatch.setattr(line_dedup, "PART_PAIRS", 10, raising=False)
    monkeypatch.setattr(line_dedup, "scratch", lambda df, label, **k: tables.append(label) or plain(df, label, **k))
    assert want and gone() == want and tables.count("line-matches") > 1
