"""The adaptive fences of the quality rules and the windows of the decontamination."""

import random

import pytest
from pyspark.sql import functions as F

from aerolytics.llm import common, quality
from tests.llm.llm_data import documents


def _texts(rnd, n_docs, words, length, symbols, dup_lines):
    """Texts of ten-word lines: words of ``length`` letters or one more, and up to the given
    numbers of symbols and repeated lines a document."""
    out = []
    for _ in range(n_docs):
        n = rnd.randrange(words, 2 * words)
        lines = [" ".join(f"{rnd.randrange(10 ** 12):0{length + rnd.randrange(2)}d}"[:length + rnd.randrange(2)] for _ in range(10))
                 for _ in range(n // 10)]
        lines += rnd.sample(lines, rnd.randrange(dup_lines + 1))
        lines[0] += " " + "#" * rnd.randrange(symbols + 1)
        out.append("\n".join(lines))
    return out


@pytest.fixture(scope="module")
def two_sources(spark):
    rnd = random.Random(11)
    plain, rich = _texts(rnd, 250, 200, 5, 1, 1), _texts(rnd, 250, 100, 9, 40, 6)
    rows = [(i, t, "en", "plain") for i, t in enumerate(plain)] + [(1000 + i, t, "en", "rich") for i, t in enumerate(rich)]
    strange = random.Random(12)
    rows += [(5000 + i, t, "en", "plain") for i, t in enumerate(_texts(strange, 5, 100, 9, 0, 0))]      # long words
    rows += [(6000 + i, plain[i] + " " + "$" * 60, "en", "plain") for i in range(5)]                    # symbols
    rows += [(7000 + i, rich[i] + " " + "$" * 10, "en", "rich") for i in range(5)]                      # usual there
    return documents(spark, rows)


def test_op10_every_fence_follows_its_source(spark, two_sources):
    sketch = common.scratch(quality.sketches(common.scratch(quality.text_metrics(two_sources), "test-metrics")), "test-sketches")
    t = {r["source"]: r for r in quality.thresholds(sketch).collect()}
    for m in quality.MEASURES:
        assert t["plain"][f"{m}_high"] < t["rich"][f"{m}_high"], m
    # no constant decides: with a width of one each fence is the quartile plus the quartile range
    rows = sketch.where("source = 'plain'").collect()
    one = quality.fences(sketch.where("source = 'plain'"), ["source"], width=1).first()
    for m in quality.MEASURES:
        v = sorted(x for r in rows if r["measure"] == m for x in [r["bucket"]] * r["n"])
        q1, q3 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
        assert q3 > q1 and one[f"{m}_high"] == q3 + (q3 - q1)


def test_op10_strange_documents_go_and_usual_ones_stay(spark, two_sources):
    out = {r["doc_id"]: r for r in quality.quality_filter(two_sources).collect()}
    for i in [*range(5000, 5005), *range(6000, 6005)]:
        assert not out[i]["base_failed"] and not out[i]["kept"]
    usual = [r for i, r in out.items() if (i < 5000 or i >= 7000) and not r["base_failed"]]
    assert len(usual) > 400 and all(r["kept"] for r in usual)


def test_op10_buckets_keep_three_digits(spark):
    v = [0, 7, 999, 1000, 1004, 12_345, 987_654_321]
    got = spark.createDataFrame([(x,) for x in v], "v long").select(quality._bucket(F.col("v")).alias("b")).collect()
    assert [r["b"] for r in got] == [0, 7, 999, 1000, 1000, 12_300, 987_000_000]
