"""Operators against brute force, exact round trips and held-out accuracy."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolytics.llm import (common, decontaminate, html_extract, line_dedup, ngram_join, packing, quality,
                            secrets, token_counts, toxicity, url_filter)
from aerolytics.llm import queries as Q
from tests.conftest import SF01, SF001
from tests.llm.llm_data import documents, sentence

RANKS, WORDS = Q.vocabulary("byte_bpe_50k.tiktoken"), Q.vocabulary("word_bpe_49k.json")


def table(spark, name, d=SF001):
    return spark.read.parquet(f"{d}/{name}.parquet")


# 1 ----------------------------------------------------------------------------------------
def test_op1_base_spans_by_hand(spark):
    out = {r["doc_id"]: r for r in Q.op1_secrets(spark, SF01).collect()}
    assign = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                        r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    import hashlib
    for i, t in table(spark, "documents", SF01).select("doc_id", "text").collect():
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m.group(1)) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
        want = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert out[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [out[i][f"n_{k}"] for k in secrets.KINDS[:3]] == [sum(x[1] == k for x in spans) for k in range(3)]


def test_op1_random_strings():
    c = secrets.TokenCounter.get(RANKS, Q.split_pattern())
    key, words = "q7Zp2LxV9fRt0KbWm3Ncy8Jd", "internationalization-of-things"
    digest = "d41d8cd98f00b204e9800998ecf8427e"
    text = f"use {key} not {words} or {digest.upper()} or 123e4567-e89b-12d3-a456-426614174000"
    found = secrets.random_spans(text, [], c, 1.9, frozenset())
    assert [text[s:e] for s, _, e in found] == [key]
    assert secrets.random_spans(text, [], c, 1.9, frozenset({key.lower()})) == []
    assert secrets.base_spans("secret=token:abcdefgh") == []       # the short match is used up


# 2 ----------------------------------------------------------------------------------------
def shingles(w):
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def test_op2_against_all_windows(spark):
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in Q.op2_decontaminate(spark, SF01).collect()}
    items = {i: t.lower().split() for i, t in table(spark, "benchmark", SF01).collect()}
    want = {}
    for d, t in table(spark, "documents", SF01).select("doc_id", "text").collect():
        w = t.lower().split()
        grams = set(shingles(w))
        for i, b in items.items():
            y = collections.Counter(shingles(b))
            if not grams & set(y):
                continue
            for s in range(-len(b) + 1, len(w)):
                x = collections.Counter(shingles(w[max(0, s):s + len(b)]))
                o = sum((x & y).values())
                j = o / (sum(x.values()) + sum(y.values()) - o)
                if j >= 0.8:
                    want[d, i] = max(want.get((d, i), 0), j)
    assert set(got) == set(want) and len(want) > 10
    assert all(abs(got[k] - want[k]) < 1e-8 for k in want)


def test_op2_blocks_find_every_print_within_radius(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(decontaminate.RADIUS + 1):
        a = [rnd.getrandbits(64) - (1 << 63) for _ in range(2)]
        b = list(a)
        for bit in rnd.sample(range(128), k):
            b[bit // 64] ^= 1 << (bit % 64) if bit % 64 < 63 else -(1 << 63)
        rows.append((k, *a, *b))
    d = spark.createDataFrame(rows, "k long, a1 long, a2 long, b1 long, b2 long")
    x = d.select("k", decontaminate._blocks(F.col("a1"), F.col("a2")).alias("b"))
    y = d.select("k", decontaminate._blocks(F.col("b1"), F.col("b2")).alias("b"))
    assert x.join(y, ["k", "b"]).select("k").distinct().count() == len(rows)


def test_op2_weights_count_occurrences(spark):
    d = spark.createDataFrame([([1, 1, 2, 3], [1, 2, 2, 4])], "a array<long>, b array<long>")
    assert d.select(decontaminate.weighted_jaccard(F.col("a"), F.col("b"))).first()[0] == pytest.approx(2 / 6)


# 3 ----------------------------------------------------------------------------------------
def test_op3_histogram(spark):
    c = token_counts.PieceCounter.get(RANKS, Q.split_pattern())
    n = [len(c.enc.encode_ordinary(r["text"] or "")) for r in table(spark, "documents").collect()]
    got = Q.op3_token_counts(spark, SF001).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(set(n))
    for r in got:
        k = r["n_tokens"]
        assert r["n_docs"] == n.count(k) and r["docs_longer"] == sum(x > k for x in n)
        assert r["tokens_to"] == sum(x for x in n if x <= k) and r["tokens_total"] == sum(n)
        assert r["tokens_truncated"] == sum(min(x, k) for x in n)
    h = Q.op3_token_counts(spark, SF001)
    for limit in (0, 100, 4096):
        assert token_counts.at_limit(h, limit).first()["tokens_truncated"] == sum(min(x, limit) for x in n)
    for q in (0.0, 0.5, 0.9, 1.0):
        assert token_counts.quantile(h, q).first()[0] == sorted(n)[max(0, int(np.ceil(q * len(n))) - 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x1c ab.'s1é́", max_size=12), max_size=6))
def test_counters_equal_the_libraries(texts):
    c, e = token_counts.PieceCounter.get(RANKS, Q.split_pattern()), packing.WordEncoder.get(WORDS)
    assert c.counts(pa.array(texts, pa.string())).tolist() == [len(c.enc.encode_ordinary(t)) for t in texts]
    flat, cuts = e.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert flat[cuts[i]:cuts[i + 1]].tolist() == e.tok.encode(t, add_special_tokens=False).ids


# 4 ----------------------------------------------------------------------------------------
def brute_lines(rows):
    seen, gone = [], {}
    for i, k, s in rows:
        best = next(((a, b) for a, b, x in seen if x == s), None) or next(
            ((a, b) for a, b, x in seen if 100 * len(x & s) >= 80 * len(x | s)), None)
        if best:
            gone[i, k] = best
        seen.append((i, k, s))
    return gone


def lines_of(docs):
    return [(i, k, frozenset(x.lower().split())) for i, t in docs for k, x in enumerate((t or "").split("\n")) if x.split()]


@pytest.mark.parametrize("long", [64, 2])
def test_op4_against_all_pairs(spark, long, monkeypatch):
    monkeypatch.setattr(line_dedup, "LONG", long)        # both ways through the lists of a word
    rnd = random.Random(11)
    base = [sentence(rnd, n, 300) for n in (3, 4, 5, 6, 9, 12, 20, 40, 60)]
    docs = []
    for i in range(60):
        out = []
        for _ in range(5):
            w = rnd.choice(base).split()
            for _ in range(rnd.randrange(4)):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(300):x}"
            out.append(" ".join(w).title() if rnd.random() < 0.3 else " ".join(w))
        docs.append((i, "\n".join(out + ["", "  "])))
    d = documents(spark, [(i, t, "en", "a") for i, t in docs]).repartition(5)
    got = {(r["doc_id"], r["line_no"]): (r["match_doc_id"], r["match_line_no"])
           for r in line_dedup.find_duplicate_lines(line_dedup.row_keys(d, "doc_id")).collect()}
    want = brute_lines(lines_of(docs))
    assert set(got) == set(want) and len(want) > 100
    if long == 64:
        assert got == want
    sets = {(i, k): x for i, k, x in lines_of(docs)}
    assert all(m < g and 100 * len(sets[g] & sets[m]) >= 80 * len(sets[g] | sets[m]) for g, m in got.items())


def test_op4_removal(spark):
    docs = [(1, "a b c\n\nx y z"), (2, "A b c\nq r s\n"), (3, "x y z"), (4, None), (5, "a b c\r\nnew")]
    d = line_dedup.row_keys(documents(spark, [(i, t, "", "") for i, t in docs]), "doc_id")
    out = line_dedup.remove_lines(d, line_dedup.find_duplicate_lines(d)).select("doc_id", "text").collect()
    assert dict(out) == {1: "a b c\n\nx y z", 2: "q r s\n", 3: "", 4: None, 5: "new"}


# 5 ----------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><body class="page">
<header><a href=/>Site</a> <nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav></header>
<div class="cookie-notice">We use cookies.</div>
<%s><h1>Caf&eacute; &amp; more</h1><p class=lead>First   <b>bold</b>
text.<p>Second &lt;tag&gt; one, long enough to be read as a paragraph of the article.<script>x("<p>no</p>")</script>
<ul><li>An item of a list that belongs to the article.</li></ul><div class="ad-banner">Buy now!</div>
<blockquote>A quote.</blockquote><form><input><button>Send</button> Subscribe</form></%s>
<section class="comments"><p>I liked this article very much, thank you for it.</p></section>
<aside><p>Related reading in the sidebar.</p></aside><footer>&copy; Site</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_op5_page(tag):
    assert html_extract.main_text(PAGE % (tag, tag)) == "\n\n".join([
        "Café & more", "First bold text.", "Second <tag> one, long enough to be read as a paragraph of the article.",
        "An item of a list that belongs to the article.", "A quote."])


def test_op5_given_pages(spark):
    got = {r["page_id"]: r for r in Q.op5_main_text(spark, SF01).collect()}
    import html
    for p, h in table(spark, "pages", SF01).select("page_id", "html").collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", h, re.S).group(1)
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " ")))).strip()
                 for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n\n".join(x for x in parts if x)
        assert got[p]["text"] == want and got[p]["n_chars"] == len(want)


def test_op5_weights_are_learned(spark):
    pages = table(spark, "pages", SF01)
    w = html_extract.fit_weights(pages)
    assert w != html_extract.DEFAULT_WEIGHTS and w[1] > 0 > w[2]
    assert html_extract.main_text(PAGE % ("article", "article"), w) == html_extract.main_text(PAGE % ("main", "main"))
    assert html_extract.fit_weights(pages.limit(0)) == html_extract.DEFAULT_WEIGHTS


def test_op5_cut_is_minimal():
    rnd = random.Random(2)
    for _ in range(40):
        n = 6
        g = html_extract.MaxFlow(n + 2)
        s, t = [rnd.random() for _ in range(n)], [rnd.random() for _ in range(n)]
        w = {(i, j): rnd.random() * 0.5 for i in range(n) for j in range(i)}
        for i in range(n):
            g.edge(n, i, s[i])
            g.edge(i, n + 1, t[i])
        for (i, j), x in w.items():
            g.edge(i, j, x, x)

        def cost(side):
            return sum(t[i] if side[i] else s[i] for i in range(n)) + sum(
                x for (i, j), x in w.items() if side[i] != side[j])
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(g.run(n, n + 1)[:n]) == pytest.approx(best)


# 6 ----------------------------------------------------------------------------------------
def test_op6_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        e, trans, first = rng.normal(size=n), rng.normal(size=(2, 2)), 0.4
        z, p = 0.0, np.zeros(n)
        for m in range(1 << n):
            tags = [m >> i & 1 for i in range(n)]
            v = np.exp(first * tags[0] + sum(e[i] * tags[i] for i in range(n))
                       + sum(trans[tags[i], tags[i + 1]] for i in range(n - 1)))
            z, p = z + v, p + v * np.array(tags)
        two = np.concatenate([e, e])
        starts = np.zeros(2 * n, bool)
        starts[[0, n]] = True
        assert np.allclose(toxicity.marginals(two, starts, trans, first), np.concatenate([p, p]) / z)


def test_op6_held_out(spark):
    got = Q.op6_toxicity(spark, SF01).join(table(spark, "labels", SF01).select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.93 * len(held)


def test_op6_column_equals_rows(spark):
    d = table(spark, "documents")
    m = toxicity.fit(table(spark, "documents", SF01), table(spark, "labels", SF01))
    a = dict(toxicity.score_documents(d, m).select("doc_id", "score").collect())
    b = dict(d.withColumn("s", toxicity.toxic_scores(d, m)).select("doc_id", "s").collect())
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


# 7 ----------------------------------------------------------------------------------------
def test_op7_rules_and_model(spark):
    got = {r["page_id"]: r for r in Q.op7_url_filter(spark, SF01).collect()}
    rules = sorted(url_filter.RULES, key=lambda x: -len(x[0]))
    for p, u in table(spark, "pages", SF01).select("page_id", "url").collect():
        host, path = url_filter.split_url(u)
        rule = next(((r, v) for r, v in rules if (host == (h := r.split("/")[0]) or host.endswith("." + h))
                     and path.startswith(r[len(h):])), None)
        r = got[p]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] == (rule[1] if rule else ("block" if r["score"] >= 0.5 else "allow"))
    model = url_filter.train(url_filter.LABELLED_URLS)
    right = [(url_filter.score(model, *url_filter.split_url(u)) >= 0.5) == bool(y) for u, y in url_filter.LABELLED_URLS]
    assert sum(right) >= 0.97 * len(right)


# 8 ----------------------------------------------------------------------------------------
def brute_components(docs):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and comp[a] != comp[b] \
                    and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(comp[a], comp[b]), min(comp[a], comp[b])
                comp = {k: new if v == old else v for k, v in comp.items()}
    return {i: (len(sets[i]), comp[i]) for i in ids}


def near_copies(rnd, n):
    docs = []
    for g in range(6):
        words = sentence(rnd, rnd.choice([6, 12, 30, 80, 200]), 3000).split()
        for _ in range(n // 6):
            w = list(words)
            for _ in range(rnd.randrange(1 + len(w) // 25 + 1)):
                k = rnd.randrange(len(w))
                w[k:k + 1] = rnd.choice([[], [f"z{rnd.randrange(50)}"], [w[k], "ins"]])
            docs.append(" ".join(w))
            if rnd.random() < 0.3:                       # copies of copies
                words = w or words
    passage = sentence(rnd, 60, 3000)
    docs += [f"{sentence(rnd, 30, 3000)} {passage}" for _ in range(40)]
    docs += ["", "a", "a b", "A B", "a b c d e"]
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, chunk", [(1, 500_000), (2, 2000)])
def test_op8_against_all_pairs(spark, seed, chunk, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", chunk)       # blocks in one piece and in many
    docs = near_copies(random.Random(seed), 240)
    d = documents(spark, [(i, t, "en", "a") for i, t in docs]).repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(d).collect()}
    assert got == brute_components(docs)


def test_op8_block_search_alone():
    rnd = random.Random(9)
    docs = near_copies(rnd, 120)
    sets = [x for x in ngram_join.shingle_sets(pa.array([t for _, t in docs])) if len(x)]
    ix = ngram_join.BlockIndex(list(range(len(sets))), list(range(len(sets))), sets, 80)
    comp = {i: i for i in range(len(sets))}
    for i, x in enumerate(sets):
        for j in ix.search(i, i, x):
            a, b = sorted((comp[i], comp[j]))
            comp = {k: a if v == b else v for k, v in comp.items()}
    want = {i: i for i in comp}
    for i in want:
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            if want[i] != want[j] and 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                a, b = sorted((want[i], want[j]))
                want = {k: a if v == b else v for k, v in want.items()}
    assert comp == want


def test_op8_components_of_a_long_path(spark):
    e = spark.range(200).selectExpr("id * 7 % 401 as x").collect()
    ids = [r["x"] for r in e]
    edges = spark.createDataFrame([(a, b) for a, b in zip(ids, ids[1:])] + [(1000, 1001)], "a long, b long")
    got = ngram_join.components(edges).collect()
    assert len(got) == 202 and len({r["comp"] for r in got}) == 2


# 9 ----------------------------------------------------------------------------------------
def test_op9_round_trip(spark):
    tok = packing.WordEncoder.get(WORDS).tok
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [2]
           for i, t in table(spark, "documents").select("doc_id", "text").collect()}
    pieces = collections.defaultdict(list)
    seqs = collections.defaultdict(list)
    for r in Q.op9_packing(spark, SF001).collect():
        x = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], dtype="<u4")
        assert zlib.crc32(x.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for parts, total in [(v, len(ids[k])) for k, v in pieces.items()] + [(v, None) for v in seqs.values()]:
        at = 0
        for s, n in sorted(parts):
            assert s == at and n > 0
            at += n
        assert at == total if total is not None else at <= 4096 and at & (at - 1) == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=30))
def test_op9_pack_fills_everything(lengths):
    pieces, cost, size = packing.pack(lengths, 16, 1.0, 0.1)
    room = collections.Counter()
    for d, s, n, k, off in pieces:
        assert off == room[k]
        room[k] += n
    assert [room[k] for k in range(len(size))] == size.tolist() and sum(size) == sum(lengths)
    assert size.tolist() == packing.capacities(sum(lengths), 16)


# 10 ---------------------------------------------------------------------------------------
def test_op10_repeats_and_lines(spark):
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choice("abcd" if i % 2 else "abcdefghijklmnop") for _ in range(rnd.randrange(400)))
             + "\n" * (i % 3) + "x y\n x y\nx y\n\n") for i in range(40)]
    docs.append((99, " ".join(f"u{k % 700}" for k in range(1500))))         # many repeated windows
    out = {r["doc_id"]: r for r in quality.quality_filter(documents(spark, [(i, t, "en", "a") for i, t in docs])).collect()}
    for i, t in docs:
        w = t.split()
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {k + j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(3)}
        ls = [x for x in t.split("\n") if x.split()]
        assert out[i]["n_repeat_words"] == len(hit) and out[i]["n_words"] == len(w)
        assert out[i]["n_dup_lines"] == len(ls) - len(set(ls)) and out[i]["word_chars"] == sum(map(len, w))


def test_op10_sketches_merge(spark):
    m = common.scratch(quality.text_metrics(table(spark, "documents", SF01)), "test-metrics")
    whole = quality.sketches(m)
    parts = quality.sketches(m.where("doc_id % 2 = 0")).unionAll(quality.sketches(m.where("doc_id % 2 = 1")))
    a, b = quality.thresholds(whole), quality.thresholds(parts.groupBy("lang", "source", "measure", "bucket")
                                                         .agg(F.sum("n").alias("n")))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


# shared ------------------------------------------------------------------------------------
def test_sieve_keeps_all_wanted(spark):
    d = spark.range(5000)
    for n in (1, 64):
        assert common.sieve(d, d.where("id % 50 = 0"), "id", n).where("id % 50 = 0").count() == 100
