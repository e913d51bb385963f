"""Secret scan with linking of credentials that come in parts.

1. Strong patterns (assignments, access identifiers, long hexadecimal runs) are findings by themselves.
2. Weak candidates say little alone: a name after ``user=``, a random-looking run, an address. Every candidate plays
   a role: identifier, secret or endpoint. So do the strong findings.
3. A candidate's scope is its paragraph within ``REACH`` code points. An interval join over cells of ``REACH`` code
   points pairs each weak candidate with the parts of complementary roles in its scope. Only candidates with such a
   part are reported.

A cell holds a bounded stretch of one text, so a text with very many candidates is spread over many keys.

Defined results: a NULL text is empty; a text without findings has zero counts and empty spans; rows with one id are
scanned each for itself; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.llm.common import stored

REACH = 200  # code points between two parts of one credential
ENTROPY = 3.5  # bits a character that a bare secret has at least

# Kinds in the order in which findings at one place are listed; the first three are the strong ones.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "secret", "endpoint")
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}
# A role is only reported beside one of these.
COMPLEMENT = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}

# The strong patterns; what is too short is dropped after matching.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

WEAK_NAMED = {
    "identifier": re.compile(r"""\b(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key(?:_?id)?|e-?mail)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""", re.A | re.I),
    "secret": re.compile(r"""\b(?:pwd|pass(?:phrase|code)?|credentials?|private_?key|auth|signature|pin)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", re.A | re.I),
    "endpoint": re.compile(r"""\b(?:host(?:_?name)?|endpoint|server|bucket|dsn)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._:/-]{4,})""", re.A | re.I),
}
BARE_SECRET = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
ADDRESS = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,19}://[^\s"'<>]+""")
PARAGRAPH = re.compile(r"\n[^\S\n]*\n")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Strong findings (kind, start, end) by start, then kind."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def looks_random(run: str) -> bool:
    """Upper and lower case letters and digits, with the entropy of chance."""
    if not (re.search("[a-z]", run) and re.search("[A-Z]", run) and re.search("[0-9]", run)):
        return False
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values()) >= ENTROPY


def weak_spans(text: str, strong: list[Span]) -> list[Span]:
    """Weak candidates (kind, start, end) that overlap no strong finding and no candidate listed before them."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(kind, m.start(), m.end()) for kind, pattern in WEAK_NAMED.items() for m in pattern.finditer(text)]
    if "://" in text:
        found += [("endpoint", m.start(), m.end()) for m in ADDRESS.finditer(text)]
    found += [("secret", m.start(), m.end()) for m in BARE_SECRET.finditer(text) if looks_random(m[0])]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), -s[2]))
    starts, ends = [], []  # strong findings joined to stretches that do not overlap
    for _, start, end in strong:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    kept, last = [], 0
    for kind, start, end in found:
        near = bisect_right(starts, end - 1) - 1
        if start >= last and (near < 0 or ends[near] <= start):
            kept.append((kind, start, end))
            last = end
    return kept


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_PARTS = "array<struct<kind:string,start:long,end:long,paragraph:long>>"


def scanned(docs: DataFrame) -> DataFrame:
    """Per row its strong findings, their digest, and all parts of credentials with their paragraph."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(f"n_assign long, n_access long, n_hex long, base_sha256 string, parts {_PARTS}")])
    types = [
        *[pa.int64()] * 3,
        pa.string(),
        pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("paragraph", pa.int64())])),
    ]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                strong = base_spans(text)
                count = Counter(kind for kind, _, _ in strong)
                spans = strong + weak_spans(text, strong)
                breaks = [m.end() for m in PARAGRAPH.finditer(text)] if len(spans) > 1 else []
                parts = [{"kind": k, "start": s, "end": e, "paragraph": bisect_right(breaks, s)} for k, s, e in spans]
                digest = hashlib.sha256(written(strong).encode()).hexdigest()
                rows.append((count["assign"], count["access"], count["hex"], digest, parts))
            columns = list(zip(*rows)) or [()] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def _role(kind):
    return F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[kind]


def linked(parts: DataFrame) -> DataFrame:
    """The weak candidates among ``parts`` (row, kind, start, end, paragraph) with the number of complementary parts in scope.

    A pair may meet in several cells; it counts in the first one that both reach.
    """
    reach = F.lit(REACH).cast("long")
    cell = lambda low, high: F.explode(F.sequence(F.floor(low / reach), F.floor(high / reach))).alias("cell")
    wants = F.create_map(*[x for role, other in COMPLEMENT.items() for x in (F.lit(role), F.array(*map(F.lit, other)))])
    low = F.greatest(F.col("start") - reach, F.lit(0).cast("long"))
    weak = parts.filter(~F.col("kind").isin(*BASE)).select(
        "row", "paragraph", "kind", "start", "end", low.alias("low"), (F.col("end") + reach).alias("high"),
        F.explode(wants[_role(F.col("kind"))]).alias("role"),
    )
    weak = weak.select("*", cell(F.col("low"), F.col("high")))
    others = parts.select(
        "row", "paragraph", _role(F.col("kind")).alias("role"), F.col("start").alias("from"), F.col("end").alias("to"),
        cell(F.col("start"), F.col("end") - 1),
    )
    meet = weak.join(others, ["row", "paragraph", "role", "cell"]).filter(
        (F.col("from") <= F.col("high")) & (F.col("to") >= F.col("low"))
        & (F.col("cell") == F.floor(F.greatest("low", "from") / reach))
    )
    return meet.groupBy("row", "kind", "start", "end").agg(F.count("*").alias("n_parts"))


def scan(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every row of ``docs``: strong findings, and weak candidates that are linked."""
    rows = stored(scanned(docs).withColumn("row", F.monotonically_increasing_id()), "scanned")
    parts = rows.filter(F.size("parts") > 1).select("row", F.explode("parts").alias("part")).select("row", "part.*")
    span = F.struct("start", "kind", "end")
    links = linked(parts).groupBy("row").agg(F.collect_list(span).alias("weak"))
    strong = F.transform(F.filter("parts", lambda p: p["kind"].isin(*BASE)), lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    every = F.when(F.col("weak").isNull(), strong).otherwise(F.concat(strong, "weak"))
    place = F.create_map(*[x for i, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(i))])
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s["start"], place[s["kind"]], s["kind"].alias("kind"), s["end"].alias("end"), s["start"].alias("from"))))
    text = F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["end"].cast("string"))), ",")
    return rows.join(links, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"), F.coalesce(F.array_size("weak"), F.lit(0)).alias("n_linked")
    )
