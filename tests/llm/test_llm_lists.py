"""Lists of two frequent words in the search for near-duplicate lines (op4_line_dedup, pipeline)."""

import pathlib
import random
import re

import pytest
from pyspark.sql import functions as F

from aerolytics.llm import line_dedup


def gone_lines(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("__row", F.col("doc_id"))
    return {r["doc_id"] for r in line_dedup.find_duplicate_lines(docs).collect()}


def brute(texts):
    sets = [frozenset(t.split()) for t in texts]
    return {i for i, s in enumerate(sets) if any(100 * len(s & e) >= 80 * len(s | e) for e in sets[:i])}


def test_frequent_words_alone_make_no_long_lists(spark, monkeypatch):
    """Lines that share one frequent word, but no two, are not compared: before, each such word had a long list."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(r.sample(words, 5)) for _ in range(100)]
    texts += [f"{t} new{i}" for i, t in enumerate(texts[:10])]
    tables, plain = [], line_dedup.scratch
    monkeypatch.setattr(line_dedup, "LONG", 8)
    monkeypatch.setattr(line_dedup, "RARE", 1, raising=False)
    monkeypatch.setattr(line_dedup, "scratch", lambda df, label, **k: tables.append(label) or plain(df, label, **k))
    want = brute(texts)
    assert gone_lines(spark, texts) == want >= set(range(100, 110))
    assert "line-members" not in tables


@pytest.mark.parametrize("keys", [32, 1])
def test_group_of_near_copies_in_long_lists(spark, monkeypatch, keys):
    r = random.Random(7)
    base, texts = [f"b{i}" for i in range(30)], []
    for _ in range(90):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 3, 4])):
            w[r.randrange(30)] = f"x{r.randrange(400)}"
        texts.append(" ".join(w[:r.choice([24, 27, 30])]))
    monkeypatch.setattr(line_dedup, "LONG", 2)
    monkeypatch.setattr(line_dedup, "RARE", 1, raising=False)
    monkeypatch.setattr(line_dedup, "KEYS", keys, raising=False)
    assert gone_lines(spark, texts) == brute(texts) and 10 < len(brute(texts)) < 90


def test_parity_bits_bound_the_words_that_differ(spark):
    r = random.Random(9)
    rows = []
    for _ in range(200):
        n, m, both = r.randrange(1, 120), r.randrange(1, 120), r.randrange(0, 60)
        new = [r.getrandbits(64) - (1 << 63) for _ in range(n + m + both)]
        rows.append((new[:n + both], new[n:], n + m))
    d = spark.createDataFrame(rows, "x array<long>, y array<long>, apart int")
    x, y = line_dedup._parity(F.col("x")), line_dedup._parity(F.col("y"))
    bits = F.bit_count(x[0].bitwiseXOR(y[0])) + F.bit_count(x[1].bitwiseXOR(y[1]))
    got = d.select("apart", bits.alias("bits")).collect()
    assert all(g["bits"] <= g["apart"] and (g["apart"] - g["bits"]) % 2 == 0 for g in got) and any(g["bits"] > 40 for g in got)


def test_lists_hold_a_share_of_the_disk(spark, monkeypatch):
    """The lists of rare words are dealt out by parts, and the table of all lines is gone by then."""
    r = random.Random(11)
    texts = [" ".join(f"w{r.randrange(2000)}" for _ in range(20)) for _ in range(60)]
    texts += [f"{t} new{i}" for i, t in enumerate(texts[:20])] + texts[30:40]
    sizes, there, plain = [], {}, line_dedup.scratch

    def watched(df, label, **k):
        lines = there.get("lines")
        sizes.append((label, lines is not None and lines.exists()))
        out = plain(df, label, **k)
        there[label] = pathlib.Path(out.inputFiles()[0].removeprefix("file:")).parent
        return out

    monkeypatch.setattr(line_dedup, "scratch", watched)
    assert gone_lines(spark, texts) == brute(texts) >= set(range(60, 90))
    parts = [held for label, held in sizes if label == "line-pairs"]
    assert len(parts) > 2 and not any(parts)


def test_words_between_any_blanks(spark):
    words = [f"w{i}" for i in range(12)]
    gaps = [" ", "  ", "\t", "\x0b", "\x0c", "\r", " \t\r "]
    texts = [g.join(words) for g in gaps] + [f"\t {' '.join(words)}  \r", " ".join(words[:11]) + " w11"]
    texts += [" \t\r\x0b\x0c", "  ", "", "A  B", "a b", "x" * 5]
    assert gone_lines(spark, texts) == brute_blanks(texts)


def brute_blanks(texts):
    sets = [frozenset(re.findall(r"[^\x20\x09-\x0D]+", t.lower())) for t in texts]
    return {i for i, s in enumerate(sets) if s and any(e and 100 * len(s & e) >= 80 * len(s | e) for e in sets[:i])}


def test_short_lines_look_up_their_first_word(spark):
    """A set of six or seven words spares none when it is the smaller one: its rarest word alone finds the match."""
    texts = []
    for n in range(4, 13):
        base = [f"s{n}w{i}" for i in range(n)]
        texts += [" ".join(base), " ".join([*base, f"more{n}"]), " ".join([*base[:-1], f"other{n}"])]
    assert gone_lines(spark, texts) == brute(texts) >= {texts.index(t) for t in texts if "more" in t}
