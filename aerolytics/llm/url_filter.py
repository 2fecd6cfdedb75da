"""URL filter: host and path rules, and logistic regression on hashed character n-grams.

The rules decide where they fit; everywhere else a linear model over hashed character
n-grams of the host and of the path gives the verdict. The model is trained from a small
labelled URL table (a bounded number of rows) and is a dictionary of bucket weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolytics.llm.common import lower_ascii, ship

MAX_RULES = 1000
MAX_TRAIN_ROWS = 20_000
BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)

# fixed values: rules of the registered query (host/path prefix, verdict)
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]

# fixed values: words of usual spam topics and of usual sites, from which the seed is built
SPAM_WORDS = [
    "casino", "poker", "roulette", "slots", "jackpot", "betting", "bets", "gambling", "lottery", "bonus", "win", "prize",
    "pills", "meds", "viagra", "pharma", "cheap", "discount", "free", "deal", "loans", "payday", "credit", "money", "cash",
    "adult", "xxx", "porn", "sex", "cams", "escort", "singles", "dating", "ads", "click", "track", "popup", "banner",
    "spam", "farm", "backlinks", "seo", "followers", "crack", "keygen", "warez", "torrent", "replica", "phishing", "malware",
    "scam", "forex", "miracle", "clickbait",
]
PLAIN_WORDS = [
    "library", "museum", "university", "school", "teacher", "students", "research", "science", "journal", "history",
    "nature", "garden", "kitchen", "recipes", "weather", "forecast", "northern", "southern", "mountain", "river", "harbour",
    "bridge", "station", "railway", "nation", "council", "government", "health", "hospital", "medicine", "institute",
    "theatre", "music", "painting", "gallery", "poetry", "novel", "bookshop", "reading", "writing", "thinking", "mother",
    "father", "brother", "children", "another", "gathering", "together", "weathered", "leather", "feather", "lantern",
    "orchard", "meadow", "forest", "ocean", "island", "travel", "notes", "diary", "photos", "camera", "statistics", "tables",
    "encyclopedia", "dictionary", "language", "translation", "grammar", "project", "software", "manual", "forum", "thread",
    "archive", "collection", "motion", "action", "election", "tradition", "invention", "engineering", "building", "ancient",
    "thousand", "hundred", "standard", "land", "handbook", "capable", "sustainable", "table", "interest", "forest-trust",
    "city", "village", "street", "sports", "results", "chess", "cycling", "running", "swimming", "community",
]
_SITES = ["", "www.", "blog.", "m."]
_ENDS = [".com", ".org", ".net", ".example.com", ".example.org", ".example.net", ".info", ".co.uk"]
_PATHS = ["/en/12", "/de/75.html", "/fr/8/", "/es/445", "", "/", "/2021/05/article.html", "/item/44"]


def seed_urls() -> list[tuple[str, int]]:
    """Labelled URLs (1: block): hosts of one or two topic words, with the same sites, ends and
    paths in both classes, so that only the words tell them apart; and the empty url, allowed.
    A stand-in for a labelled table of one's own (:func:`labelled_rows`)."""
    rows = [("", 0)]
    for label, words in ((1, SPAM_WORDS), (0, PLAIN_WORDS)):
        n = len(words)
        for i, w in enumerate(words):
            names = [w, f"{w}-{words[(7 * i + 3) % n]}", f"{w}{words[(11 * i + 5) % n]}", f"{words[(13 * i + 1) % n]}-{w}"]
            for k, name in enumerate(names[:4 if label else 3]):
                at = 5 * i + 3 * k
                rows.append((f"https://{_SITES[at % 4]}{name}{_ENDS[(at // 4 + k) % 8]}{_PATHS[(at // 3 + i) % 8]}", label))
    return rows


LABELLED_URLS = seed_urls()


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased) and path
    (then up to ``?`` or ``#``). Null or without ``://``: both empty."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls. A rule ``host/path`` fits
    its host and every subdomain where the url's path starts with the rule's path."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    rule = verdict = F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: (len(x[0]), x[0])):      # the longest is tested first
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule = F.when(fits, F.lit(r)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def split_url(url: str | None) -> tuple[str, str]:
    """:func:`host_path` for the training rows."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[cut:]
    end = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:cut].translate({c: c + 32 for c in range(65, 91)}), path[:end]


def buckets(host: str, path: str, n_buckets: int = BUCKETS) -> list[int]:
    """Distinct hashed n-grams; host and path have n-grams of their own."""
    out = set()
    for side, s in (("h", host), ("p", path)):
        s = f"^{s}$"
        for n in NGRAMS:
            for i in range(len(s) - n + 1):
                out.add(zlib.crc32(f"{side}{s[i:i + n]}".encode("utf-8", "replace")) % n_buckets)
    return sorted(out)


def train(rows: list[tuple[str, int]], epochs: int = 600, rate: float = 0.5,
          l2: float = 3e-4, n_buckets: int = BUCKETS) -> dict[int, float]:
    """Weights by bucket (-1: bias) of an L2-regularised logistic regression, by full
    gradient steps over the labelled rows (at most :data:`MAX_TRAIN_ROWS`)."""
    if not rows or len(rows) > MAX_TRAIN_ROWS:
        raise ValueError(f"1 to {MAX_TRAIN_ROWS} labelled rows are needed")
    feats = [buckets(*split_url(u), n_buckets) for u, _ in rows]
    names = sorted({b for f in feats for b in f})
    at = {b: i for i, b in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for r, f in enumerate(feats):
        x[r, [at[b] for b in f]] = 1.0 / math.sqrt(max(1, len(f)))
    y = np.array([float(t) for _, t in rows])
    w, bias = np.zeros(len(names)), 0.0
    for _ in range(epochs):
        p = 1.0 / (1.0 + np.exp(-(x @ w + bias)))
        w -= rate * len(rows) ** 0.5 * (x.T @ (p - y) / len(rows) + l2 * w)
        bias -= rate * float((p - y).mean())
    return {-1: bias} | {b: float(w[i]) for b, i in at.items()}


def score(model: dict[int, float], host: str, path: str, n_buckets: int = BUCKETS) -> float:
    f = buckets(host, path, n_buckets)
    z = model[-1] + sum(model.get(b, 0.0) for b in f) / math.sqrt(max(1, len(f)))
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def labelled_rows(table: DataFrame, url_col: str = "url", label_col: str = "label") -> list[tuple[str, int]]:
    """A small labelled table as training rows; larger than the bound: an error."""
    rows = table.select(url_col, label_col).where(F.col(label_col).isNotNull()).limit(MAX_TRAIN_ROWS + 1).collect()
    return sorted((r[0] or "", int(r[1])) for r in rows)


def judge_urls(pages: DataFrame, model: dict[int, float], rules: list[tuple[str, str]],
               id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score (null where a rule decides).

    Null urls and urls without a scheme have empty host and path and are judged by the
    model. Repeated rows and null ids are kept; an empty table gives no rows; other
    columns are not read.
    """
    ship(pages.sparkSession)
    host, path = host_path(F.col(url_col))
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    d = d.select("*", rule.alias("rule"), verdict.alias("verdict"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, paths, verdicts = (b.column(i).to_pylist() for i in (1, 2, 4))
            s = [None if v is not None else score(model, h, p)
                 for h, p, v in zip(hosts, paths, verdicts)]
            v = [v if v is not None else "block" if x >= threshold else "allow"
                 for v, x in zip(verdicts, s)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(4)), pa.array(v, pa.string()), pa.array(s, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "score"])

    return d.mapInArrow(run, "page_id long, host string, path string, rule string, "
                             "verdict string, score double")
