import hashlib
import random
import re

from pyspark.sql import functions as F

from quotewell.llm import secrets
from tests.llm.samples import docs_of, odd_texts


def brute(text):
    found = [
        (m.start(), 0, f"assign:{m.start()}:{m.end()}")
        for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 6
    ]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(s for _, _, s in sorted(found))


def test_base_spans_by_brute_force(spark):
    rng = random.Random(8)
    bits = ["token", "TOKEN", "api_key", "apikey", "Secret", "=", ":", " ", '"', "'", "AKIA", "ABCD1234", "deadbeef", "0123456789", "é☃", "\n", "-", "x", "paſſword", "passwd"]
    rows = odd_texts() + [(100 + k, "".join(rng.choices(bits, k=40))) for k in range(300)]
    out = secrets.span_digest(secrets.find(secrets.numbered(docs_of(spark, rows)))).collect()
    want = sorted((i is None, i or 0, brute(t or "")) for i, t in rows)
    hashes = sorted((i, d, hashlib.sha256(b.encode()).hexdigest()) for i, d, b in want)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["base_sha256"]) for r in out) == hashes
    count = lambda kind: sum(b.count(f"{kind}:") for _, _, b in want)
    assert [sum(r[f"n_{k}"] for r in out) for k in ("assign", "access", "hex")] == [count(k) for k in ("assign", "access", "hex")]


def test_weak_parts_need_each_other(spark):
    rows = [
        (1, "user: bob key: abcdefgh1 host: db.example.com:80"),
        (2, "user: bob likes music"),
        (3, "key: abcdefgh1"),
        (4, "user: bob\n\nkey: abcdefgh1"),  # two scopes
        (5, "user: bob " + "x" * 300 + " key: abcdefgh1"),  # too far
        (6, "host: db.example.com"),
        (7, "login=amy\ntoken = abcdef12"),
    ]
    found = {r["doc_id"]: r["spans"] for r in secrets.span_digest(secrets.find(secrets.numbered(docs_of(spark, rows)))).collect()}
    assert found == {1: "linked_id:0:9,linked_secret:10:24,linked_endpoint:25:48", 2: "", 3: "", 4: "", 5: "", 6: "", 7: "linked_id:0:9,assign:10:26"}
    assert secrets.find(secrets.numbered(docs_of(spark, []))).count() == 0


def test_parts_chain_over_long_parts_and_comments(spark):
    url = "https://store.example.com/file?sig=" + "x" * 400
    comment = "# rotated every quarter by the platform team, ask them first\n"
    far = "lorem ipsum " * 25
    rows = [
        (1, f"user: bob\nurl: {url}\nkey: abcdefgh1"),
        (2, "user: bob\n" + comment * 6 + "key: abcdefgh1"),
        (3, f"user: bob {far}key: abcdefgh1"),
        (4, f"user: bob {far[:150]} host: db.example.com {far[:150]} key: abcdefgh1"),
        (5, f"user: bob {far}host: db.example.com key: abcdefgh1"),
    ]
    found = {r["doc_id"]: r["spans"] for r in secrets.span_digest(secrets.find(secrets.numbered(docs_of(spark, rows)))).collect()}
    kinds = {k: [x.split(":")[0] for x in v.split(",") if x] for k, v in found.items()}
    every = ["linked_id", "linked_endpoint", "linked_secret"]
    assert kinds == {1: every, 2: ["linked_id", "linked_secret"], 3: [], 4: every, 5: []}


def test_redaction(spark):
    df = spark.createDataFrame(
        [("abcdefgh", [(0, 2), (1, 4), (6, 8)]), ("abc", []), ("☃bc", [(1, 2)]), ("abcd", [(0, 2), (0, 2)])], "t string, s array<struct<start:int,end:int>>"
    )
    out = [r[0] for r in df.select(secrets.redacted(F.col("t"), F.col("s"), "#")).collect()]
    assert out == ["#ef#", "abc", "☃#c", "#cd"]
