"""Benchmark items in documents: SimHash of item-sized windows, Hamming blocks, exact verification.

A document's windows of as many words as an item has get a 64-bit SimHash of
their words.  Items and windows of one size meet where one of thirteen blocks of
their fingerprints is equal, which by the pigeonhole principle finds every pair
within a distance of twelve bits.  A pair counts if the similarity of the two
bags of five-word shingles, each weighing as often as it occurs, is 0.8 or more.

Only windows that can reach that are fingerprinted: a bit map of fixed size says
of every shingle whether items of the window's size may have it, and a window
with too few of such shingles cannot be similar enough to any of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import bit_map, in_slices, stored
from quotewell.llm.shingles import MULTIPLIERS, WordHashes, mixed, shingle_hashes

WORD = re.compile(r"[^\W_]+")
SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 12
#: Bits of the map of shingles; its size does not depend on the number of items.
MAP_BITS = 24
WINDOW = "doc_id long, doc_hash long, words int, start int, begin int, finish int, fingerprint long, shingles array<long>"


def for_size(hashes: np.ndarray, words: int) -> np.ndarray:
    """The same hashes, but of shingles of items of so many words."""
    return mixed(hashes + np.uint64(words * int(MULTIPLIERS[1]) % 2**64))


def fingerprint(words: np.ndarray) -> int:
    """SimHash of a bag of words, as a signed long."""
    bits = np.unpackbits(mixed(words).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    return int(np.packbits(2 * bits.sum(axis=0) > len(words)).view(np.int64)[0])


def places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) to (item_id, words, fingerprint, shingles, places in the map)."""
    known = WordHashes()
    for batch in in_slices(batches):
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = known.of(WORD.findall(text.lower()))
            if len(words):
                shingles = shingle_hashes(words, SHINGLE)
                at = np.concatenate([places(shingles), places(for_size(shingles, len(words)))])
                rows.append((item, len(words), fingerprint(words), np.sort(shingles).view(np.int64).tolist(), at.tolist()))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "words", "fingerprint", "shingles", "places"]
        )


@dataclass(frozen=True)
class Windows:
    """(doc_id, doc_hash, text) to the windows that items of their size may be similar to."""

    bits: bytes
    sizes: tuple[int, ...]
    similarity: float = SIMILARITY

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = np.unpackbits(np.frombuffer(self.bits, np.uint8), bitorder="little")
        known = WordHashes()
        for batch in in_slices(batches):
            rows: list[tuple] = []
            for doc_id, doc_hash, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows += [(doc_id, doc_hash, *w) for w in self.of(text, known, present)]
            kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.list_(pa.int64()))
            columns = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in WINDOW.split(", ")])

    def of(self, text: str, known: WordHashes, present: np.ndarray) -> Iterator[tuple]:
        lowered = text.lower()
        words = known.of(WORD.findall(lowered))
        if not len(words):
            return
        by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        spans: list[tuple[int, int]] | None = None
        for size in self.sizes:
            width = min(size, SHINGLE, len(words))
            if width not in by_width:
                shingles = shingle_hashes(words, width)
                by_width[width] = shingles, np.flatnonzero(present[places(shingles)])
            shingles, hits = by_width[width]
            own = min(size, len(words)) - width + 1  # shingles of a window, and of an item
            item = size - min(size, SHINGLE) + 1
            need = int(np.ceil(self.similarity / (1 + self.similarity) * (own + item) - 1e-9))
            if len(hits) < need or own < need:
                continue
            hits = hits[present[places(for_size(shingles[hits], size))] > 0]
            if len(hits) < need:
                continue
            sums = np.zeros(len(shingles) + 1, np.int32)
            sums[hits + 1] = 1
            sums = np.cumsum(sums)
            starts = np.flatnonzero(sums[own:] - sums[: len(sums) - own] >= need)
            if len(starts) and spans is None:
                spans = [m.span() for m in WORD.finditer(text)]
                if len(spans) != len(words):  # a letter whose lower case is several characters
                    spans = [m.span() for m in WORD.finditer(lowered)]
            for start in starts.tolist():
                end = start + own + width - 1
                yield (
                    size, start, spans[start][0], spans[end - 1][1], fingerprint(words[start:end]),
                    np.sort(shingles[start : start + own]).view(np.int64).tolist(),
                )


def bag_similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the weighted Jaccard similarity of the last two columns' bags in place of them."""
    for batch in in_slices(batches, 2048):
        out = []
        for a, b in zip(*(batch.column(i).to_pylist() for i in (-2, -1))):
            x, n = np.unique(np.array(a, np.int64), return_counts=True)
            y, m = np.unique(np.array(b, np.int64), return_counts=True)
            _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            both = int(np.minimum(n[i], m[j]).sum())
            out.append(both / (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, pa.float64())], names=[*batch.schema.names[:-2], "similarity"])


def blocks(table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``table`` once for each of the ``radius`` + 1 blocks of its fingerprints: block number and value."""
    count = radius + 1
    cuts = [64 * k // count for k in range(count + 1)]
    values = [
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fingerprint", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
    ]
    return table.withColumn("x", F.explode(F.array(*values))).select("*", "x.*").drop("x")


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, item_id, similarity, begin, finish): the most similar window of each document and item.

    Documents and items of any length are read whole, in lower case, as runs of
    letters and digits.  A document shorter than an item has itself as its only
    window; an item of fewer than five words is one shingle.  Null and empty
    texts on either side match nothing.  Equal rows of id and text are one
    document; items of one id are told apart by their texts, the best one counts.
    ``begin`` and ``finish`` are code points of the text.  Other columns are
    left behind; with no items or no documents there are no rows.
    """
    spark = docs.sparkSession
    found_items = stored(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
            item_rows, "item_id long, words int, fingerprint long, shingles array<long>, places array<long>"
        ),
        "items",
    )
    bits = bit_map(found_items.select(F.explode("places").alias("p")), MAP_BITS)
    sizes = tuple(sorted(r["words"] for r in found_items.select("words").distinct().collect()))  # at most the longest item's words
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    packed = spark.sparkContext.broadcast(Windows(bits, sizes))
    windows = stored(
        rows.select("doc_id", F.xxhash64("text").alias("doc_hash"), "text").mapInArrow(lambda b: packed.value(b), WINDOW), "windows"
    ).withColumn("uid", F.struct("doc_id", "doc_hash", "words", "start"))
    index = blocks(found_items.select("item_id", "words", "fingerprint")).withColumnRenamed("fingerprint", "other")
    pairs = (
        blocks(windows.select("uid", "words", "fingerprint"))
        .join(index, ["words", "block", "value"])
        .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= RADIUS)
        .select("uid", "item_id", F.col("other"))
        .distinct()
    )
    verified = (
        pairs.join(windows.select("uid", "begin", "finish", "shingles").dropDuplicates(["uid"]), pairs["uid"].eqNullSafe(windows["uid"]))
        .select(pairs["uid"].alias("uid"), "item_id", "other", "begin", "finish", "shingles")
        .join(found_items.select(F.col("item_id").alias("id"), F.col("fingerprint").alias("print"), F.col("shingles").alias("theirs")), F.col("item_id").eqNullSafe(F.col("id")) & (F.col("other") == F.col("print")))
        .select("uid.doc_id", "uid.doc_hash", "item_id", "begin", "finish", "shingles", "theirs")
        .mapInArrow(bag_similarity, "doc_id long, doc_hash long, item_id long, begin int, finish int, similarity double")
        .where(F.col("similarity") >= SIMILARITY)
    )
    return (
        verified.groupBy("doc_id", "doc_hash", "item_id")
        .agg(F.max(F.struct("similarity", -F.col("begin"), "finish")).alias("best"))
        .select("doc_id", "doc_hash", "item_id", "best.similarity", (-F.col("best.col2")).alias("begin"), "best.finish")
    )


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) in which no item was found."""
    gone = leaks(docs, items).select(F.col("doc_id").alias("#id"), F.col("doc_hash").alias("#hash")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(gone["#id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["#hash"])
    return docs.join(gone, same, "left_anti")
