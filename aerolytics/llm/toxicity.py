"""Toxic spans and document scores by a linear-chain conditional random field.

Two tags (ordinary, toxic). A token's emission score sums the weights of its features
(the word, its prefixes and suffixes, the words beside it); tags of neighbours are tied
by transition weights. The field is trained by gradient steps on labelled tokens: in
documents labelled toxic, the tokens with a feature that is much commoner in toxic than
in clean documents. Forward-backward marginals of a document's tokens give the offending
offsets and, through a small calibrated logistic layer over their aggregates, its score.

The chain of a whole block of documents is evaluated at once: the forward and backward
ratios are Moebius maps, composed per chunk of the chain with numpy and then chained over
the chunks, so the cost is linear in tokens however long a document is.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolytics.llm.common import WORD, byte_slices, coded_words, release_memory, ship

BUCKETS = 1 << 18
FOLDS = 5
MAX_TRAIN_TOXIC = 1000
MAX_TRAIN_CLEAN = 2000
TRAIN_BLOCK = 4096              # windows of tokens that are evaluated at once
WINDOW = 64
CACHE_WORDS = 150_000
TOKEN = re.compile(WORD)
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…–—¡¿"


PIECE = re.compile(r"[\W_]*(?:[^\W_]|['’])+[\W_]*|[\W_]+")
INNER = re.compile(r"[^\W_][\W_]+[^\W_]")
LONGEST = 24                    # characters of a token; longer runs are cut
CUT = 8                         # into tokens whose prefixes reach their end


def pieces(word: str) -> list[str]:
    """The tokens of a run without blanks: cut behind inner punctuation (not apostrophes), and
    what is longer than ``LONGEST`` into consecutive tokens, so that every character of a text
    reaches the features of some token."""
    if len(word) <= LONGEST and not INNER.search(word):
        return [word]
    out = []
    for m in PIECE.finditer(word):
        s = m.group()
        out += [s] if len(s) <= LONGEST else [s[i:i + CUT] for i in range(0, len(s), CUT)]
    return out


def tokens(text: str) -> Iterator[tuple[int, str]]:
    """Start and characters of every token of a text."""
    for m in TOKEN.finditer(text):
        at = m.start()
        for s in pieces(m.group()):
            yield at, s
            at += len(s)


def features(word: str) -> list[str]:
    """The word and its affixes, without case and outer punctuation."""
    w = word.lower().strip(EDGES) or word[:CUT]
    out = ["w" + w]
    out += ["p" + w[:k] for k in range(3, 9) if len(w) > k]
    out += ["s" + w[-k:] for k in (2, 3, 4) if len(w) > k]
    return out


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


@dataclass
class Model:
    """Trained weights; ``labelled`` is false where there was nothing to learn from."""
    own: np.ndarray            # emission weight of each bucket
    prev: np.ndarray           # of the word before
    next: np.ndarray           # of the word behind
    bias: float
    trans: np.ndarray          # log potentials [from, to]
    first: float               # log odds of the toxic tag at a start
    layer: np.ndarray          # of the document layer
    labelled: bool = True


def _chain(head: np.ndarray, m: np.ndarray, fixed: np.ndarray, value: np.ndarray) -> np.ndarray:
    """r_t = (m00 r_{t-1} + m01) / (m10 r_{t-1} + m11), or ``value`` where ``fixed``."""
    n = len(fixed)
    if n == 0:
        return np.zeros(0)
    size = max(1, int(np.ceil(np.sqrt(n))))
    rows = -(-n // size)
    pad = rows * size - n
    a, b, c, d = (np.concatenate([x, np.full(pad, y)]).reshape(rows, size)
                  for x, y in zip(m, (1.0, 0.0, 0.0, 1.0)))
    f = np.concatenate([fixed, np.zeros(pad, bool)]).reshape(rows, size)
    v = np.concatenate([value, np.zeros(pad)]).reshape(rows, size)
    # a fixed step forgets what came before
    a, b, c, d = np.where(f, 0.0, a), np.where(f, v, b), np.where(f, 0.0, c), np.where(f, 1.0, d)
    A, B, C, D = a[:, 0], b[:, 0], c[:, 0], d[:, 0]
    for t in range(1, size):
        p, q, r, s = a[:, t], b[:, t], c[:, t], d[:, t]
        A, B, C, D = p * A + q * C, p * B + q * D, r * A + s * C, r * B + s * D
        k = 1.0 / (A + B + C + D)
        A, B, C, D = A * k, B * k, C * k, D * k
    start = np.empty(rows)
    x = float(head[0])
    for i in range(rows):
        start[i] = x
        x = (A[i] * x + B[i]) / (C[i] * x + D[i])
    out = np.empty((size, rows))
    x = start
    for t in range(size):
        x = (a[:, t] * x + b[:, t]) / (c[:, t] * x + d[:, t])
        out[t] = x
    return out.T.reshape(-1)[:n]


def marginals(e: np.ndarray, starts: np.ndarray, trans: np.ndarray, first: float) -> np.ndarray:
    """Probability of the toxic tag of every token; ``e`` are log odds, ``starts`` marks
    the first token of each document."""
    n = len(e)
    if n == 0:
        return np.zeros(0)
    x = np.exp(np.clip(e, -30, 30))
    t = np.exp(trans)
    one = np.ones(n)
    fwd = _chain(np.ones(1), [x * t[1, 1], x * t[0, 1], one * t[1, 0], one * t[0, 0]],
                 starts, x * np.exp(first))
    ends = np.append(starts[1:], True)
    y = np.append(x[1:], 1.0)
    # b_t = (t10 + t11 y b) / (t00 + t01 y b) with y, b of the token behind
    back = _chain(np.ones(1), [(y * t[1, 1])[::-1], one * t[1, 0], (y * t[0, 1])[::-1],
                               one * t[0, 0]], ends[::-1], one)[::-1]
    z = fwd * back
    return z / (1.0 + z)


class Scorer:
    """Emission scores through a bounded cache of words, for one worker task."""

    def __init__(self, model: Model):
        self.m = model
        self.reset()

    def reset(self):
        self.at: dict[str, int] = {}
        self.own, self.prev, self.next = (np.zeros(1024) for _ in range(3))

    def _add(self, words: list[str]) -> None:
        need = len(self.at) + len(words)
        if need > len(self.own):
            self.own, self.prev, self.next = (np.concatenate([x, np.zeros(need)]) for x in
                                              (self.own, self.prev, self.next))
        for w in words:
            b = [bucket(f) for f in features(w)]
            i = self.at[w] = len(self.at)
            self.own[i] = self.m.own[b].sum()
            self.prev[i], self.next[i] = self.m.prev[b[0]], self.m.next[b[0]]

    def score(self, texts: pa.Array):
        """Marginals of all tokens, and the first token of each text (and the end)."""
        if len(self.at) > CACHE_WORDS:
            self.reset()
        codes, names, cut = coded_words(texts)
        parts = [pieces(w) for w in names.to_pylist()]
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = [s for p in parts for s in p]
        self._add([w for w in dict.fromkeys(flat) if w not in self.at])
        seq = np.fromiter(map(self.at.__getitem__, flat), np.int32, len(flat))
        if len(flat) == len(parts):
            seq = seq[codes]
        else:                                            # runs of several tokens
            n, first = size[codes], np.cumsum(size) - size
            ends = np.cumsum(n)
            seq = seq[np.repeat(first[codes] - (ends - n), n) + np.arange(ends[-1])]
            cut = np.concatenate([[0], ends])[cut]
        starts = np.zeros(len(seq), bool)
        starts[cut[:-1][cut[:-1] < cut[1:]]] = True
        e = self.m.bias + self.own[seq]
        if len(seq) > 1:
            inner = ~starts[1:]
            e[1:] += np.where(inner, self.prev[seq[:-1]], 0.0)
            e[:-1] += np.where(inner, self.next[seq[1:]], 0.0)
        return marginals(e, starts, self.m.trans, self.m.first), cut


def aggregates(p: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Per document: 1, log expected toxic tokens, largest log odds, share of toxic tokens."""
    n = np.diff(cut)
    out = np.zeros((len(n), 4))
    out[:, 0] = 1.0
    full = n > 0
    if len(p):
        at = cut[:-1][full]
        total = np.add.reduceat(p, at)
        top = np.clip(np.maximum.reduceat(p, at), 1e-6, 1 - 1e-6)
        out[full, 1] = np.log1p(total)
        out[full, 2] = np.log(top / (1 - top))
        out[full, 3] = np.sqrt(total / n[full])
    out[~full, 2] = np.log(1e-6)
    return out


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_layer(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Newton steps of a weighted, L2-regularised logistic regression."""
    w = np.zeros(x.shape[1])
    ridge = l2 * np.diag([1e-3] + [1.0] * (x.shape[1] - 1))
    for _ in range(25):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge @ w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def mark_words(owner: np.ndarray, hashes: np.ndarray, n_words: int, pairs: list[np.ndarray],
               n_docs: list[int], odds: float = 6.0, strength: float = 10.0) -> np.ndarray:
    """True for the words that mark toxic tokens: those with a feature that is ``odds`` times
    likelier in toxic than in clean documents, by enough evidence.

    ``owner`` and ``hashes`` hold the word and prefix features of all words; ``pairs``, for
    clean and toxic documents, the second words of the distinct (word before, word) pairs:
    an occurrence in a copied passage counts once, however many copies there are.
    """
    names, flat = np.unique(hashes, return_inverse=True)
    seen = [np.bincount(flat, np.bincount(p, minlength=n_words)[owner], len(names)) for p in pairs]
    ratio = (seen[1] / n_docs[1]) / ((seen[0] + 0.5) / n_docs[0])
    good = (ratio >= odds) & (np.log(np.maximum(ratio, 1e-9)) * np.sqrt(seen[1]) >= strength)
    return np.bincount(owner, good[flat], n_words) > 0


def _block_gradient(ids, y, mask, word, par, total, grad) -> None:
    """Add one block's gradient of the negative log likelihood: per word (own, before,
    behind) to ``total``, of the other parameters to ``grad``."""
    size, V = len(ids), len(total[0])
    pair = mask[:, 1:] & mask[:, :-1]
    e = par["bias"] + word[0][ids]
    e[:, 1:] += word[1][ids[:, :-1]]
    e[:, :-1] += np.where(mask[:, 1:], word[2][ids[:, 1:]], 0.0)
    x = np.where(mask, np.exp(np.clip(e, -30, 30)), 1.0)
    t = np.exp(par["trans"])
    fwd, back = np.empty((WINDOW, size)), np.ones((WINDOW, size))
    fwd[0] = x[:, 0] * np.exp(par["first"])
    for k in range(1, WINDOW):
        fwd[k] = x[:, k] * (t[0, 1] + fwd[k - 1] * t[1, 1]) / (t[0, 0] + fwd[k - 1] * t[1, 0])
    for k in range(WINDOW - 2, -1, -1):
        z = x[:, k + 1] * back[k + 1]
        back[k] = np.where(mask[:, k + 1], (t[1, 0] + t[1, 1] * z) / (t[0, 0] + t[0, 1] * z), 1.0)
    fwd, back = fwd.T, back.T
    p = fwd * back
    d = np.where(mask, p / (1 + p) - y, 0.0)
    # expected less observed transitions
    z, f = (x[:, 1:] * back[:, 1:])[pair], fwd[:, :-1][pair]
    j = [[np.full_like(z, t[0, 0]), t[0, 1] * z], [t[1, 0] * f, t[1, 1] * f * z]]
    norm = 1.0 / (j[0][0] + j[0][1] + j[1][0] + j[1][1])
    a, b = y[:, :-1], y[:, 1:]
    seen = np.array([[(pair & ~a & ~b).sum(), (pair & ~a & b).sum()],
                     [(pair & a & ~b).sum(), (pair & a & b).sum()]], float)
    grad["trans"] += np.array([[float(v @ norm) for v in row] for row in j]) - seen
    grad["bias"] += d.sum()
    grad["first"] += d[:, 0].sum()
    total[0] += np.bincount(ids[mask], d[mask], V)
    total[1] += np.bincount(ids[:, :-1][pair], d[:, 1:][pair], V)
    total[2] += np.bincount(ids[:, 1:][pair], d[:, :-1][pair], V)


def train(rows: list[tuple[str, int]], weights: dict[int, float] | None = None, rounds: int = 30,
          rate: float = 0.5, l2: float = 0.02) -> Model:
    """Fit the field and the document layer on ``(text, toxic)`` rows in memory.

    ``weights`` are the true shares of the classes in the labelled table against the rows
    given. Without a row of each class the model is marked unlabelled (all scores 0).
    """
    zero = np.zeros(BUCKETS)
    toxic = np.array([y for _, y in rows], dtype=int)
    if not len(rows) or toxic.min() == toxic.max():
        return Model(zero, zero, zero, 0.0, np.zeros((2, 2)), 0.0, np.zeros(4), labelled=False)
    vocab: dict[str, int] = {}
    seqs = [np.fromiter((vocab.setdefault(w, len(vocab)) for _, w in tokens(t)), np.int64) for t, _ in rows]
    if not vocab:
        return Model(zero, zero, zero, 0.0, np.zeros((2, 2)), 0.0, np.zeros(4), labelled=False)
    pairs = []
    for k in (0, 1):
        code = [(np.append(len(vocab), x[:-1]) * (len(vocab) + 1) + x) for x, v in zip(seqs, toxic)
                if v == k and len(x)]
        code = np.unique(np.concatenate(code)) if code else np.zeros(0, np.int64)
        pairs.append(code % (len(vocab) + 1))
    # hashes of the features of all words; the first of a word is the word itself
    hashes, marks, count = array("I"), array("B"), array("B")
    for w in vocab:
        fs = features(w)
        hashes.extend(zlib.crc32(f.encode("utf-8", "replace")) for f in fs)
        marks.extend(f[0] == "w" or f[0] == "p" and len(f) > 4 for f in fs)
        count.append(len(fs))
    count = np.frombuffer(count, np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(vocab), dtype=np.int32), count)
    hashes, marks = np.frombuffer(hashes, np.uint32), np.frombuffer(marks, np.uint8) > 0
    bad = mark_words(owner[marks], hashes[marks], len(vocab), pairs,
                     [max(1, int((toxic == k).sum())) for k in (0, 1)])
    flat = (hashes % BUCKETS).astype(np.int32)
    first = flat[np.cumsum(count) - count]

    # windows of tokens as padded matrices, block by block
    cuts = [(i, s) for i, x in enumerate(seqs) for s in range(0, len(x), WINDOW)]
    ids = np.zeros((len(cuts), WINDOW), np.int32)
    gold = np.zeros((len(cuts), WINDOW), bool)
    full = np.zeros((len(cuts), WINDOW), bool)
    for r, (i, s) in enumerate(cuts):
        x = seqs[i][s:s + WINDOW]
        ids[r, :len(x)], gold[r, :len(x)], full[r, :len(x)] = x, bad[x] & bool(toxic[i]), True
    V = len(vocab)
    par = {"own": np.zeros(BUCKETS), "prev": np.zeros(BUCKETS), "next": np.zeros(BUCKETS),
           "bias": np.full(1, -3.0), "trans": np.zeros((2, 2)), "first": np.zeros(1)}
    acc = {k: np.full_like(v, 1e-8) for k, v in par.items()}
    n_tok = float(full.sum())
    for _ in range(rounds):
        word = [np.bincount(owner, par["own"][flat], V), par["prev"][first], par["next"][first]]
        total = [np.zeros(V) for _ in range(3)]
        grad = {"bias": np.zeros(1), "trans": np.zeros((2, 2)), "first": np.zeros(1)}
        for at in range(0, len(cuts), TRAIN_BLOCK):
            _block_gradient(ids[at:at + TRAIN_BLOCK], gold[at:at + TRAIN_BLOCK], full[at:at + TRAIN_BLOCK],
                            word, par, total, grad)
        grad["own"] = np.bincount(flat, total[0][owner], BUCKETS) + l2 * par["own"]
        grad["prev"] = np.bincount(first, total[1], BUCKETS) + l2 * par["prev"]
        grad["next"] = np.bincount(first, total[2], BUCKETS) + l2 * par["next"]
        for k, g in grad.items():
            g = g / max(1.0, n_tok ** 0.5)
            acc[k] += g * g
            par[k] = par[k] - rate * g / np.sqrt(acc[k])
    model = Model(par["own"], par["prev"], par["next"], float(par["bias"][0]), par["trans"],
                  float(par["first"][0]), np.zeros(4))
    scorer = Scorer(model)
    feats = []
    for s in range(0, len(rows), 200):
        feats.append(aggregates(*scorer.score(pa.array([t for t, _ in rows[s:s + 200]], pa.string()))))
    weight = np.array([(weights or {}).get(int(v), 1.0) for v in toxic])
    model.layer = fit_layer(np.concatenate(feats), toxic.astype(float), weight)
    return model


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo :data:`FOLDS`."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TRAIN_TOXIC,
        max_clean: int = MAX_TRAIN_CLEAN) -> Model:
    """Train from the labelled rows outside fold 0, on a sample bounded per class.

    The sample is drawn by a hash of the id below a share computed from the class counts,
    so it is the same whatever the partitioning; at most about ``max_toxic`` and
    ``max_clean`` texts reach the driver. A document labelled twice counts as toxic when
    any label says so; null ids and null labels are not used.
    """
    y = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0))
         .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
         .agg(F.max("toxic").cast("int").alias("toxic")))
    n = {int(r["toxic"]): r["count"] for r in y.groupBy("toxic").count().collect()}
    share = {0: min(1.0, max_clean / max(1, n.get(0, 0))), 1: min(1.0, max_toxic / max(1, n.get(1, 0)))}
    pick = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1_000_003)) / 1_000_003.0
    chosen = y.where(pick < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    # the sample is bounded by construction, so its ids may be broadcast
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").collect())
    rows = sorted({(r["doc_id"], r["text"], r["toxic"]) for r in rows})
    model = train([(t, k) for _, t, k in rows], {c: 1.0 / s for c, s in share.items() if s > 0})
    del rows
    release_memory()
    return model


def toxic_scores(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A column with the score of each text of ``docs`` (see :func:`score_documents`), for
    filters that keep all columns of the table in place."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)        # a fixed number of buckets

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        scorer = Scorer(m)
        for texts in batches:
            parts = [block_scores(m, scorer, texts.slice(lo, hi - lo))[0]
                     for lo, hi in byte_slices(texts, 4 << 20)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR_ITER)(F.col(text_col))


def block_scores(m: Model, scorer: Scorer, texts: pa.Array):
    """Scores, marginals and cuts of a block of texts."""
    if not m.labelled:
        return np.zeros(len(texts)), np.zeros(0), np.zeros(len(texts) + 1, int)
    p, cut = scorer.score(texts)
    return _sigmoid(aggregates(p, cut) @ m.layer), p, cut


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.5) -> DataFrame:
    """One row per document: id, score (0 to 1), predicted (1 from ``threshold``) and spans,
    the offending tokens (code points, end exclusive; a token counts from a marginal of
    one half).

    Null texts count as empty; a text without words gets the score of a document without
    toxic tokens. Null ids and repeated rows are kept; an empty table gives no rows; other
    columns are not read. Whole texts are scored.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)        # a fixed number of buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for lo, hi in byte_slices(batch.column(1), 4 << 20):
                texts = batch.column(1).slice(lo, hi - lo)
                s, p, cut = block_scores(m, scorer, texts)
                spans = []
                for i in range(len(texts)):
                    hit = np.flatnonzero(p[cut[i]:cut[i + 1]] >= 0.5)
                    if not len(hit):
                        spans.append([])
                        continue
                    want = set(hit.tolist())
                    spans.append([{"start": at, "end": at + len(x)}
                                  for k, (at, x) in enumerate(tokens(texts[i].as_py())) if k in want])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(s, pa.float64()),
                     pa.array((s >= threshold).astype(np.int32), pa.int32()),
                     pa.array(spans, pa.list_(span))], names=["doc_id", "score", "predicted", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int, "
                             "spans array<struct<start:long,`end`:long>>"))
