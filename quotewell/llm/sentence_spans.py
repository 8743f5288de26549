"""Removal of repeated runs of sentences across all documents.

From every sentence on, the shortest run of at least two sentences and twenty
words is hashed.  Spark counts halves of the hashes; those that occur twice go
into a map of fixed size, and only runs in the map are shuffled with their
places.  Of these it finds for each whole hash the first run of all documents;
the sentences that any other run covers are removed.  A sentence longer than twenty
words counts as several, so that a text without marks has runs as well.  It is
cut where its words say so, wherever the sentence began: before a word whose
hash, taken with the word before, is the least of eight neighbours.  Pieces have
at most eight words, and cuts eight words or more inside a repeated stretch are
the same in all its copies, so copies of fifty words without marks share a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.bits import bit_words, has_bit
from quotewell.llm.common import in_slices, stored, texts

MIN_SENTENCES, MIN_WORDS = 2, 20
#: Of so many neighbouring places in a long sentence, the one with the least hash is a cut.
NEIGHBOURS = 8
MAX_SEEN = 300_000
#: Bits of the map of half hashes that occur twice (16 MB); a fuller map only lets more runs through.
MAP_BITS = 27
SENTENCE = re.compile(r"(?:[^.!?\n]+|[.!?]+(?![.!?\s]))*(?:[.!?]+(?=\s|\Z))?\s*")
WORD = re.compile(r"\S+")
RUNS = "low long, high long, doc_id long, doc_hash long, position int"


class WordHashes(dict):
    """Hashes of words, kept between calls."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_SEEN:
            self.clear()
        return self.setdefault(word, xxhash.xxh64_intdigest(word))


HASHES = WordHashes()
MIX = np.uint64(0x9E3779B97F4A7C15)


def over_neighbours(values: np.ndarray, pick: np.ufunc, out: np.ndarray | None = None) -> np.ndarray:
    """``pick`` over each eight neighbouring values."""
    values = pick(values[:-1], values[1:])
    values = pick(values[:-2], values[2:])
    return pick(values[:-4], values[4:], out=out)


def cuts(words: list[str]) -> list[int]:
    """Places before which a long sentence is cut, by its words alone; at most NEIGHBOURS apart, ends included.

    A place is a cut if it has the least hash of any window of NEIGHBOURS places
    that holds it, that is if no other least hash around is larger than its own.
    """
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    places = h[:-1] * MIX + h[1:]
    least = np.zeros(len(places) + NEIGHBOURS - 1, np.uint64)
    inner = least[NEIGHBOURS - 1 : len(places)]
    over_neighbours(places, np.minimum, inner)
    return (np.flatnonzero(places == over_neighbours(least, np.maximum)) + 1).tolist()


def sentences(text: str) -> list[tuple[int, str, int]]:
    """(start, normalised words, number of words) of each sentence; blank stretches belong to the sentence before."""
    found: list[tuple[int, str, int]] = []
    for m in SENTENCE.finditer(text):
        words = m[0].lower().split()
        if len(words) <= MIN_WORDS:
            if words:
                found.append((m.start(), " ".join(words), len(words)))
            continue
        starts = [w.start() for w in WORD.finditer(m[0])]
        places = [0, *cuts(words), len(words)]
        for at, end in zip(places, places[1:]):
            part = words[at:end]
            found.append((m.start() + (starts[at] if at else 0), " ".join(part), len(part)))
    return found


def run_ends(found: list[tuple[int, str, int]]) -> list[int]:
    """For each sentence, where the run that starts with it ends (exclusive), or 0 if the text is too short for one."""
    ends, end, words = [0] * len(found), 0, 0
    for i in range(len(found)):
        while end < len(found) and (end - i < MIN_SENTENCES or words < MIN_WORDS):
            words += found[end][2]
            end += 1
        if end - i >= MIN_SENTENCES and words >= MIN_WORDS:
            ends[i] = end
        words -= found[i][2]
    return ends


def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, doc_hash) to (doc_id, doc_hash, runs): 128-bit hashes of the runs by sentence, zero where none starts."""
    for batch in in_slices(batches):
        packed = []
        for text in batch.column(1).to_pylist():
            found = sentences(text)
            hashes = [
                xxhash.xxh3_128_digest("\n".join([s for _, s, _ in found[i:end]])) if end else b"\0" * 16 for i, end in enumerate(run_ends(found))
            ]
            packed.append(b"".join(hashes))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], names=["doc_id", "doc_hash", "runs"])


def of_batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, hash as two numbers) of all runs of a batch of ``parsed`` rows."""
    packed = batch.column(2).to_pylist()
    sizes = np.fromiter((len(p) // 16 for p in packed), np.int64, len(packed))
    hashes = np.frombuffer(b"".join(packed), np.uint64).reshape(-1, 2)
    rows = np.repeat(np.arange(len(packed)), sizes)
    positions = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    there = hashes.any(1)
    return rows[there], positions[there], hashes[there]


def half_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (low, n) of the runs by one half of their hash, of which nothing else is shuffled."""
    held: list[np.ndarray] = []

    def counted() -> Iterator[pa.RecordBatch]:
        low, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        for at in range(0, len(low), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(low[part].view(np.int64)), pa.array(n[part], pa.int64())], names=["low", "n"])

    for batch in in_slices(batches):
        held.append(of_batch(batch)[2][:, 0])
        if sum(map(len, held)) > 1 << 20:
            yield from counted()
    if held:
        yield from counted()


@dataclass(frozen=True)
class Repeated:
    """``parsed`` rows to one row for each run whose half hash is in the map of those that occur twice."""

    twice: Broadcast
    bits: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows, positions, hashes = of_batch(batch)
            kept = has_bit(self.twice.value, hashes[:, 0] & np.uint64((1 << self.bits) - 1))
            rows, positions, hashes = rows[kept], positions[kept], hashes[kept]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.ascontiguousarray(hashes[:, k]).view(np.int64)) for k in (0, 1)),
                    batch.column(0).take(pa.array(rows)),
                    batch.column(1).take(pa.array(rows)),
                    pa.array(positions, pa.int32()),
                ],
                names=["low", "high", "doc_id", "doc_hash", "position"],
            )


def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, starts of repeated runs) to (doc_id, text, n_sentences, n_removed)."""
    for batch in in_slices(batches):
        out, total, gone = [], [], []
        for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            found = sentences(text)
            ends = run_ends(found) if starts else []
            covered = {k for i in starts or () for k in range(i, ends[i])}
            total.append(len(found))
            gone.append(len(covered))
            if covered:
                bounds = [s for s, _, _ in found[1:]] + [len(text)]
                begins = [0] + [s for s, _, _ in found[1:]]
                text = "".join(text[b:e] for k, (b, e) in enumerate(zip(begins, bounds)) if k not in covered).strip()
            out.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.string()), pa.array(total, pa.int32()), pa.array(gone, pa.int32())],
            names=["doc_id", "text", "n_sentences", "n_removed"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_sentences, n_removed) for each row of ``docs``: texts without repeated runs of sentences.

    The first run of a kind is that of the smallest (doc_id, hash of the text,
    position), null ids first; it stays.  Words are compared in lower case and
    without regard to white space.  Rows of equal id and text are the same
    document, treated alike.  Null and empty texts stay empty.  Texts are read
    whole, whatever their length; other columns are left behind.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("doc_hash", F.xxhash64("text"))
    cut = stored(rows.mapInArrow(parsed, "doc_id long, doc_hash long, runs binary"), "runs")
    halves = cut.mapInArrow(half_counts, "low long, n long").groupBy("low").agg(F.sum("n").alias("n")).where("n > 1")
    places = halves.select(F.col("low").bitwiseAND(F.lit((1 << MAP_BITS) - 1)).alias("p"))
    twice = spark.sparkContext.broadcast(bit_words(places, 1 << (MAP_BITS - 6)))
    found = stored(cut.mapInArrow(Repeated(twice, MAP_BITS), RUNS), "repeated-runs")
    twice.destroy()
    place = F.struct("doc_id", "doc_hash", "position")
    first = (
        found.groupBy("low", "high")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("low", "high", "first")
    )
    first = stored(first, "first-runs")  # a join of two shuffles of their own, of which a hot run's can be split
    later = (
        found.join(first.hint("merge"), ["low", "high"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy(F.col("doc_id").alias("of_id"), F.col("doc_hash").alias("of_hash"))
        .agg(F.collect_set("position").alias("starts"))
    )
    same = rows["doc_id"].eqNullSafe(later["of_id"]) & (rows["doc_hash"] == later["of_hash"])
    return (
        rows.join(later, same, "left")
        .select("doc_id", "text", "starts")
        .mapInArrow(rebuilt, "doc_id long, text string, n_sentences int, n_removed int")
    )
