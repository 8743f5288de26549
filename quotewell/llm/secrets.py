"""Secrets in texts: certain ones by pattern, weak ones only where parts that belong together lie near each other.

The base patterns (assignments, access keys, long hexadecimal runs) stand alone.
Weak candidates, such as ``user: x``, ``key: y`` or a host, mean something only
together.  All parts become rows of (text, scope, kind of part, interval), and
windows over the sorted starts inside each scope chain parts that lie within
reach, from the end of those before to the start of the next.  A weak part is
kept if its chain has its complements, however long the chain or its parts are.
A scope is a paragraph; comment lines don't count as distance.  Positions are
code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotewell.llm.common import in_slices, stored, texts

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

# Weak parts: the name of a field, its mark, and a value.
WEAK_ID = re.compile(
    r"""\b(?:user(?:name|_?id)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?|tenant(?:_?id)?)["']?\x20*[:=]\x20*["']?[\w.@+-]{3,}""",
    re.I | re.A,
)
WEAK_SECRET = re.compile(
    r"""\b(?:pass|pwd|key|auth|bearer|credentials?|signature|client_?key|private_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=~!-]{8,}""",
    re.I | re.A,
)
ENDPOINT = re.compile(
    r"""\b(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|(?:endpoint|host|hostname|server|base_?url)["']?\x20*[:=]\x20*["']?[\w.-]+\.[\w.:/-]+|\d{1,3}(?:\.\d{1,3}){3}:\d{2,5}\b)""",
    re.I | re.A,
)
#: Lines that don't count as distance between parts.
COMMENT = re.compile(r"^[ \t]*(?:#|//|/\*|;|--)[^\n]*\n?", re.M)
SCOPE_END = re.compile(r"\n[ \t\r]*\n")
#: What one of the patterns needs in a text to match at all; cheaper to look for than the patterns.
HINT = re.compile(r"[:=]")

SPAN = "struct<kind:string,start:int,end:int>"
PART = "struct<scope:int,part:string,strong:boolean,start:int,end:int,skipped:int>"
SCAN = f"doc_id long, base array<{SPAN}>, parts array<{PART}>"
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
ARROW_PART = pa.list_(
    pa.struct(
        [("scope", pa.int32()), ("part", pa.string()), ("strong", pa.bool_())] + [(x, pa.int32()) for x in ("start", "end", "skipped")]
    )
)
KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end): sorts as the digest asks for."""
    found = []
    if HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def parts(text: str, base: list[tuple[int, int, str]]) -> list[dict]:
    """Strong and weak parts with their scopes; a weak part inside a base span is none of its own.

    ``skipped`` is the length of all comment lines before the part.
    """
    if not HINT.search(text):
        return []
    weak = [
        (m.start(), m.end(), part)
        for pattern, part in ((WEAK_ID, "id"), (WEAK_SECRET, "secret"), (ENDPOINT, "endpoint"))
        for m in pattern.finditer(text)
    ]
    if not weak:
        return []
    ends = [m.start() for m in SCOPE_END.finditer(text)]
    rows = [(start, end, "id" if rank == 1 else "secret", True) for start, rank, end in base]
    rows += [(s, e, p, False) for s, e, p in weak if not any(b < e and s < c for b, _, c in near(base, s))]
    rows.sort()
    comments = [m.span() for m in COMMENT.finditer(text)]
    out, scope, line, skipped = [], 0, 0, 0
    for start, end, part, strong in rows:
        while scope < len(ends) and ends[scope] < start:
            scope += 1
        while line < len(comments) and comments[line][1] <= start:
            skipped += comments[line][1] - comments[line][0]
            line += 1
        out.append({"scope": scope, "part": part, "strong": strong, "start": start, "end": end, "skipped": skipped})
    return out


def near(base: list[tuple[int, int, str]], start: int) -> list[tuple[int, int, str]]:
    """Base spans around ``start``: of each kind they don't overlap, so a few neighbours do."""
    from bisect import bisect_left

    at = bisect_left(base, (start, 0, 0))
    return base[max(0, at - 4) : at + 4]


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        spans, loose = [], []
        for text in batch.column(2).to_pylist():
            base = base_spans(text)
            spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in base])
            loose.append(parts(text, base))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, ARROW_SPAN), pa.array(loose, ARROW_PART)],
            names=["uid", "doc_id", "base", "parts"],
        )


def linked(scan: DataFrame, reach: int = 200) -> DataFrame:
    """(uid, linked): weak parts with complements in their chain.

    Parts of a scope are a chain while each begins at most ``reach`` code points,
    without comment lines, after the end of all before it.  An id needs a secret
    and a secret an id; an endpoint needs both.
    """
    rows = scan.select("uid", F.explode("parts").alias("x")).select("uid", "x.*")
    sorted_parts = Window.partitionBy("uid", "scope").orderBy("start", "end", "part", "strong")
    before = sorted_parts.rowsBetween(Window.unboundedPreceding, -1)
    far = F.col("start") - F.col("skipped") - F.max(F.col("end") - F.col("skipped")).over(before) > reach
    rows = rows.withColumn("far", F.coalesce(far, F.lit(False)).cast("int"))
    rows = rows.withColumn("chain", F.sum("far").over(sorted_parts.rowsBetween(Window.unboundedPreceding, 0)))
    chain = Window.partitionBy("uid", "scope", "chain")
    has_id, has_secret = (F.max(F.col("part") == part).over(chain) for part in ("id", "secret"))
    complete = F.when(F.col("part") == "id", has_secret).when(F.col("part") == "secret", has_id).otherwise(has_id & has_secret)
    return (
        rows.withColumn("complete", complete)
        .where("complete AND NOT strong")
        .groupBy("uid")
        .agg(F.collect_list(F.struct(F.concat(F.lit("linked_"), F.col("part")).alias("kind"), "start", "end")).alias("linked"))
    )


def find(docs: DataFrame, reach: int = 200) -> DataFrame:
    """(uid, doc_id, base, spans): base spans, and all spans by start and kind, for each row with uid, doc_id, text.

    Null and empty texts have no spans.  Repeated rows and ids are told apart by
    ``uid``, which must name a row.  Texts are read whole.
    """
    uid = docs.schema["uid"].dataType.simpleString()
    scan = stored(docs.select("uid", "doc_id", "text").mapInArrow(scanned, f"uid {uid}, {SCAN}"), "secrets")
    ranks = F.create_map(*[F.lit(x) for k in enumerate(KINDS) for x in reversed(k)])
    order = lambda s: F.struct(s["start"], F.element_at(ranks, s["kind"]).alias("rank"), s["end"], s["kind"])
    every = F.concat("base", F.coalesce("linked", F.array().cast(f"array<{SPAN}>")))
    spans = F.transform(
        F.array_sort(F.transform(every, order)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return scan.join(linked(scan, reach), "uid", "left").select("uid", "doc_id", "base", spans.alias("spans"))


def numbered(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, text) with a number for each row."""
    return texts(docs).select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")


def spans_text(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans and all spans as text, for each document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(spans_text("base").cast("binary"), 256).alias("base_sha256"),
        spans_text("spans").alias("spans"),
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with the union of ``spans`` (sorted by start) replaced, overlapping and touching spans by one mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] > acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(fresh | (acc["at"] == 0), F.concat(acc["out"], F.when(fresh, gap).otherwise(""), F.lit(mark))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, 2147483647)))
