"""Secret scans by multipart credential linking.

Strong patterns (assignments, access identifiers, long hex runs) are reported
as they stand. Weak candidates - opaque tokens and service endpoints - are
reported only where complementary parts occur together: an interval join
within a scope puts each access identifier beside the secrets and endpoints
whose intervals fall in its reach. A scope is a paragraph (text between blank
lines); the reach is a number of code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.llm import common

KINDS = ("assign", "access", "hex", "opaque", "endpoint")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Weak parts: 32 characters or more with both cases and a digit, URL-escaped ones included; a URL with a host.
#: A token may follow '=', as in env files and URL parameters; a run before '=' and a value is a name.
#: It doesn't begin inside an escape, so one long run is looked at once.
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])(?!(?<=%)[23][BbDdFf])(?:[A-Za-z0-9+/_-]|%2[BbFf]){32,}+(?:=|%3[Dd]){0,2}+(?![A-Za-z0-9+/_=-])")
ESCAPE = re.compile(r"%[23][BDFbdf]")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?::[0-9]+)?(?:/[^\s\"'<>]*)?", re.ASCII)
SCOPE = re.compile(r"\n[\x20\t\r]*\n")
REACH = 400


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong patterns."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def linked_spans(text: str, base: list[tuple[int, int, int]], reach: int = REACH) -> list[tuple[int, int, int]]:
    """Weak spans that complete a credential.

    An access identifier plus a secret (strong or opaque) in one scope and
    reach reports the opaque token; an access identifier plus a secret plus an
    endpoint reports the endpoint as well. An assignment stands for an
    identifier when an endpoint is there too.
    """
    ids = [s for s in base if s[1] == 1]
    assigned = [s for s in base if s[1] == 0]
    if not ids and not assigned:
        return []
    starts, upto = [a for a, _, _ in base], _upto(base)
    before = lambda p: bisect_left(starts, p) - 1
    free = lambda m: before(m.end()) < 0 or upto[before(m.end())] <= m.start()
    ends = [m.start() for m in SCOPE.finditer(text)]
    scope = lambda p: bisect_left(ends, p)
    opaque = [(m.start(), 3, m.end()) for m in OPAQUE.finditer(text) if _opaque(m[0]) and free(m)] if ids else []
    points = [(m.start(), 4, m.end()) for m in ENDPOINT.finditer(text)] if "http" in text else []
    secrets = [_Parts(x) for x in (assigned, [s for s in base if s[1] == 2], opaque)]
    at = _Parts(points)
    found = set()
    for i in ids:
        strong, runs, weak = (p.near(i, scope, reach) for p in secrets)
        found.update(weak)
        if strong or runs or weak:
            found.update(at.near(i, scope, reach))
    for s in assigned:
        found.update(at.near(s, scope, reach))
    return sorted(found)


def _opaque(t: str) -> bool:
    t = ESCAPE.sub("", t)
    return any(c.isdigit() for c in t) and any(c.islower() for c in t) and any(c.isupper() for c in t)


def _upto(ys) -> list[int]:
    """The furthest end so far at each of the sorted parts."""
    return list(accumulate((y[2] for y in ys), max))


class _Parts:
    """The parts of one kind: they don't overlap, so both their starts and their ends are sorted."""

    def __init__(self, parts: list[tuple[int, int, int]]):
        self.parts = parts
        self.starts, self.ends = [a for a, _, _ in parts], [b for _, _, b in parts]

    def near(self, x: tuple[int, int, int], scope, reach: int) -> list[tuple[int, int, int]]:
        """Interval join with one part: same scope, gap within reach; only parts in reach are looked at."""
        here = scope(x[0])
        inside = slice(bisect_left(self.ends, x[0] - reach), bisect_right(self.starts, x[2] + reach))
        return [y for y in self.parts[inside] if y != x and scope(y[0]) == here]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_text(text: str) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    n = [sum(s[1] == k for s in base) for k in range(3)]
    spans = sorted({*base, *linked_spans(text, base)})
    return (*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document with span counts, the digest of the base spans and all spans.

    Offsets are code points, ends exclusive. Null and empty texts have no spans
    (counts 0, digest of the empty string, empty span list). Repeated rows give a
    row each; an empty table gives no rows; only doc_id and text are read. A text costs
    its length, and for each identifier or assignment the parts in its reach, however
    long and nested other parts are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scan_text(t) for k in range(0, b.num_rows, 256) for t in b.column(1).slice(k, 256).to_pylist()]
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    return src.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op7_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(common.table(spark, sf_dir, "documents"))
