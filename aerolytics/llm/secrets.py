"""Secrets in texts: three fixed patterns and a token-efficiency test.

Random strings compress badly under a byte-level BPE vocabulary that was made for text:
a key has one to two characters a token, words have four or more. Candidate strings
(long runs of key characters, less what a pattern's span covers) whose ratio falls below a
threshold are reported as kind ``random``, unless they are known digests or identifiers.
Where the ratio of a whole run does not, every window of ``WINDOW`` characters of it is
tested: a key behind a name or a path is found by itself.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.llm.common import byte_slices, ship

KINDS = ("assign", "access", "hex", "random")

# fixed values: the base patterns and their shortest length
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")              # 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")

# candidates of the method, and the shapes it leaves alone
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
IDENTIFIER = re.compile(
    r"(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # UUID
    r"|[0-9_+/=-]+"                                                          # numbers, dates
    r"|(.)\1+"                                                               # rules
    r"|[A-Za-z](?:[/_-]+[A-Za-z])*)\Z")                                      # spelled out
#: inside a run: what no window reaches into (UUIDs, numbers and dates, rules)
APART = re.compile(
    r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[0-9]+(?:[/_+=-]+[0-9]+)+(?![A-Za-z0-9])|[+/_=-]{3,}")
PART = re.compile(r"[A-Za-z0-9]+")

SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,`end`:long>>"


class TokenCounter:
    _open: dict[str, TokenCounter] = {}

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks,
                                     special_tokens={})

    @classmethod
    def get(cls, path: str, pattern: str) -> TokenCounter:
        if path not in cls._open:
            cls._open[path] = cls(path, pattern)
        return cls._open[path]

    def chars_per_token(self, s: str, block: int = 1000) -> float:
        """Blocks keep the merging of a very long run linear."""
        n = sum(len(self.enc.encode_ordinary(s[i:i + block])) for i in range(0, len(s), block))
        return len(s) / n

    def bounds(self, s: str, block: int = 1000) -> list[int]:
        """Where the tokens of an ASCII string begin, and its length."""
        out = [0]
        for i in range(0, len(s), block):
            for token in self.enc.encode_ordinary(s[i:i + block]):
                out.append(out[-1] + len(self.enc.decode_single_token_bytes(token)))
        return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the three patterns, code points."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
           if m.end(2) - m.start(2) >= ASSIGN_MIN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def known(s: str, digests: frozenset[str]) -> bool:
    """Digests by length and alphabet or by list, identifiers by shape."""
    return (s.lower() in digests or (len(s) in DIGEST_LENGTHS and bool(DIGEST.match(s)))
            or bool(IDENTIFIER.match(s)))


def window_spans(v: str, counter: TokenCounter, max_ratio: float,
                 digests: frozenset[str]) -> list[tuple[int, int]]:
    """Parts of a run in which windows of whole tokens, ``WINDOW`` characters or just more,
    have few characters a token; widened to the letters and digits they cut."""
    apart = [m.span() for m in APART.finditer(v)]
    apart += [m.span() for m in PART.finditer(v) if m.end() - m.start() >= WINDOW and known(m.group(), digests)]
    out: list[tuple[int, int]] = []
    for lo, hi in left_over(0, len(v), apart):
        at = counter.bounds(v[lo:hi])
        j, found = 0, []
        for i in range(len(at)):
            while j < len(at) and at[j] - at[i] < WINDOW:
                j += 1
            if j == len(at):
                break
            if at[j] - at[i] <= max_ratio * (j - i):
                if found and at[i] <= found[-1][1]:
                    found[-1][1] = at[j]
                else:
                    found.append([at[i], at[j]])
        for s, e in found:
            s, e = s + lo, e + lo
            while s > lo and v[s].isalnum() and v[s - 1].isalnum():
                s -= 1
            while e < hi and v[e].isalnum() and v[e - 1].isalnum():
                e += 1
            while not v[s].isalnum():
                s += 1
            if out and s < out[-1][1]:
                out[-1] = (out[-1][0], max(e, out[-1][1]))
            else:
                out.append((s, e))
    return out


def left_over(s: int, e: int, spans) -> list[tuple[int, int]]:
    """What of ``s`` to ``e`` no span covers, if long enough for a candidate."""
    out = []
    for lo, hi in sorted(spans):
        if lo >= e:
            break
        if lo - s >= WINDOW:
            out.append((s, lo))
        s = max(s, hi)
    if e - s >= WINDOW:
        out.append((s, e))
    return out


def random_spans(text: str, base, counter: TokenCounter, max_ratio: float,
                 digests: frozenset[str]) -> list[tuple[int, int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        # a pattern's span is cut out, the rest is tested
        for s, e in left_over(*m.span(), [(b[0], b[2]) for b in base if b[0] < m.end() and b[2] > m.start()]):
            v = text[s:e].rstrip("=")
            if known(v, digests):
                continue
            if counter.chars_per_token(v) <= max_ratio:
                out.append((s, 3, e))
            else:
                out += [(s + a, 3, s + b) for a, b in window_spans(v, counter, max_ratio, digests)]
    return out


def find_secrets(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", max_ratio: float = 1.9,
                 known_digests: frozenset[str] = frozenset()) -> DataFrame:
    """One row per document: its id and its spans (kind, start, end; code points, end
    exclusive) by start, then kind in the order of :data:`KINDS`.

    ``vocabulary`` is a rank file, ``pattern`` its splitting rule, ``max_ratio`` the most
    characters a token of a random string, ``known_digests`` lower-case values to leave
    alone. Null and empty texts have no spans; null ids and repeated rows are kept; an
    empty table gives no rows; other columns are not read. Whole texts are searched.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter.get(vocabulary, pattern)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for lo, hi in byte_slices(batch.column(1)):
                rows = []
                for text in batch.column(1).slice(lo, hi - lo).to_pylist():
                    base = base_spans(text) if text else []
                    more = random_spans(text, base, counter, max_ratio, known_digests) if text else []
                    rows.append([{"kind": KINDS[k], "start": s, "end": e}
                                 for s, k, e in sorted(base + more)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(rows, pa.list_(kind))],
                    names=["doc_id", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))
