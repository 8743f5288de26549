"""Spelling variants: words one edit apart, found by probing generated edits against Bloom filters.

The vocabulary is put into blocked Bloom filters, one for each word length, of a
bounded size together, which are broadcast.  Each word generates the edits that
delete or replace one code point (an insertion is another word's deletion);
hashes of all of them follow from the word's own by arithmetic, for all words of
a length at once.  Only edits that a filter takes for a word are written out and
shuffled to an exact join with the vocabulary, which removes the filter's errors.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.common import in_slices, stored
from quotewell.llm.shingles import LOWER, mixed

RUN = re.compile("[A-Za-zÀ-ÿ]{6,}")
#: One of so many (document, run) pairs loses a code point.
TYPO = 199
LEAST_LENGTH = 6
MAX_SEEN = 300_000
#: A block is one line of cache: 512 bits; each word sets PROBES of them.
BLOCK_BITS, PROBES = 512, 6
#: Bits for each word, as long as all filters stay below 2 ** MOST_BITS (32 MB); words of LAST code points and more share a filter.
WORD_BITS, MOST_BITS, LAST = 20, 28, 48
#: Hashes computed at once in a task, and words of a task: a small table of words is much work.
CHUNK = 1 << 20
TASK_WORDS = 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def letters_of(doc_id: int | None, text: str) -> Counter:
    """The runs of a text, A to Z in lower case, each with its typo where the document's id calls for one."""
    out: Counter = Counter()
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.lower() if text.isascii() else text.translate(LOWER))).items():
        h = zlib.crc32(run.encode(), begin)
        if h % TYPO == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] += n
    return out


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to partial (word, n)."""
    counts: Counter = Counter()
    for batch in in_slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update(letters_of(doc_id, text))
        if len(counts) > MAX_SEEN:
            yield from flush(counts)
    yield from flush(counts)


def flush(counts: Counter) -> Iterator[pa.RecordBatch]:
    words, n = list(counts), list(counts.values())
    for at in range(0, len(words), 20_000):
        yield pa.RecordBatch.from_arrays([pa.array(words[at : at + 20_000], pa.string()), pa.array(n[at : at + 20_000], pa.int64())], names=["word", "n"])
    counts.clear()


def shard_of(length: int) -> int:
    return min(length, LAST)


def code_hashes(code_points: np.ndarray) -> np.ndarray:
    return mixed(code_points.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))


def powers(length: int) -> np.ndarray:
    """BASE ** 0, 1, ..., ``length`` - 1, modulo 2 ** 64."""
    out = np.full(length, BASE)
    out[:1] = 1
    return np.multiply.accumulate(out)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, code points as a matrix) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, np.frombuffer("".join(words[k] for k in at).encode("utf-32-le"), np.uint32).reshape(len(at), length)


def bits_of(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Block of each hash, and PROBES bits within it."""
    h = mixed(hashes)
    block = (h >> np.uint64(32)) % np.uint64(blocks)
    spread = mixed(h + np.uint64(1))
    return block, [(spread >> np.uint64(9 * k)) & np.uint64(BLOCK_BITS - 1) for k in range(PROBES)]


@dataclass(frozen=True)
class Bloom:
    """One filter: its blocks in 64-bit words, and the code points of the words in it."""

    words: np.ndarray
    alphabet: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be a word's; never False for one that is."""
        block, bits = bits_of(hashes, len(self.words) * 64 // BLOCK_BITS)
        block *= np.uint64(BLOCK_BITS // 64)
        found = np.ones(len(hashes), bool)
        for bit in bits:
            found &= (self.words[block + (bit >> np.uint64(6))] >> (bit & np.uint64(63))) & np.uint64(1) != 0
        return found


@dataclass(frozen=True)
class FilterBits:
    """(word) to the (shard, place) of its bits, for filters of the given numbers of blocks."""

    blocks: dict[int, int]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points in by_length(batch.column(0).to_pylist()):
                shard = shard_of(points.shape[1])
                block, bits = bits_of((code_hashes(points) * powers(points.shape[1])).sum(1, dtype=np.uint64), self.blocks[shard])
                places = np.concatenate([block * np.uint64(BLOCK_BITS) + b for b in bits])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), shard, np.int32)), pa.array(places.view(np.int64))], names=["shard", "p"]
                )


def bloom_filters(vocabulary: DataFrame) -> dict[int, Bloom]:
    """The filters of ``vocabulary`` (word) by shard: built in Spark, together at most 2 ** MOST_BITS bits and a block for each shard."""
    shard = F.least(F.char_length("word"), F.lit(LAST))
    counts = {r["shard"]: r["count"] for r in vocabulary.groupBy(shard.alias("shard")).count().collect()}  # at most LAST rows
    each = min(WORD_BITS, (1 << MOST_BITS) / max(1, sum(counts.values())))
    blocks = {s: 1 + int(n * each / BLOCK_BITS) for s, n in counts.items()}
    places = vocabulary.select("word").mapInArrow(FilterBits(blocks), "shard int, p long")
    word, mask = F.expr("shiftright(p, 6)").alias("word"), F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("mask")
    masks = places.groupBy("shard", word).agg(mask).toArrow()  # at most as many rows as the filters have words
    at, where, values = (masks[c].to_numpy() for c in ("shard", "word", "mask"))
    letters = vocabulary.select(shard.alias("shard"), F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabets: dict[int, list[int]] = {}
    for r in letters.collect():  # at most LAST times the number of letters in RUN
        if r["letter"]:
            alphabets.setdefault(r["shard"], []).append(ord(r["letter"]))
    out = {}
    for s, n in blocks.items():
        words = np.zeros(n * BLOCK_BITS // 64, np.uint64)
        words[where[at == s]] = values[at == s].view(np.uint64)
        out[s] = Bloom(words, np.array(sorted(alphabets[s]), np.uint32))
    return out


@dataclass(frozen=True)
class Probe:
    """(word, n) to (edit, word, n, deleted) for each edit by deletion or replacement that a filter may hold."""

    filters: Broadcast

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, Bloom] = self.filters.value
        for batch in in_slices(batches, 4096):
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for at, points in by_length(words):
                for who, edits, deleted in self.edits(points, filters):
                    whole = at[who]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(edits, pa.string()),
                            pa.array([words[k] for k in whole], pa.string()),
                            pa.array(counts[whole], pa.int64()),
                            pa.array([deleted] * len(edits), pa.bool_()),
                        ],
                        names=["edit", "word", "n", "deleted"],
                    )

    def edits(self, points: np.ndarray, filters: dict[int, Bloom]) -> Iterator[tuple[np.ndarray, list[str], bool]]:
        """(rows of ``points``, edits, whether by deletion), chunk by chunk."""
        length = points.shape[1]
        power = powers(length)
        same, shorter = filters[shard_of(length)], filters.get(shard_of(length - 1))
        wide = max(1, CHUNK // (length * len(same.alphabet)))  # words at once; a very long word goes place by place
        for begin in range(0, len(points), wide):
            part = points[begin : begin + wide]
            terms = code_hashes(part) * power
            sums = np.cumsum(terms, axis=1, dtype=np.uint64)
            whole = sums[:, -1:]
            if shorter is not None:
                moved = sums - terms + (whole - sums) * BASE_INVERSE  # all but one, those after it one place to the left
                row, place = np.divmod(np.flatnonzero(shorter.has(moved.ravel())), length)
                yield begin + row, [text(np.delete(part[r], p)) for r, p in zip(row, place)], True
            for first in range(0, length, max(1, CHUNK // (len(part) * len(same.alphabet)))):
                some = slice(first, first + max(1, CHUNK // (len(part) * len(same.alphabet))))
                rest = (whole - terms)[:, some, None]
                edited = rest + code_hashes(same.alphabet) * power[some, None]
                held = same.has(edited.ravel()).reshape(edited.shape) & (part[:, some, None] != same.alphabet)
                row, place, letter = np.nonzero(held)
                yield begin + row, [replaced(part[r], first + p, same.alphabet[c]) for r, p, c in zip(row, place, letter)], False


def text(points: np.ndarray) -> str:
    return points.astype(np.uint32).tobytes().decode("utf-32-le")


def replaced(points: np.ndarray, at: int, letter: int) -> str:
    points = points.copy()
    points[at] = letter
    return text(points)


def vocabulary(docs: DataFrame, least: int = 5) -> DataFrame:
    """(word, n): the words of at least LEAST_LENGTH code points that occur ``least`` times in ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for every two words of ``words`` (word, n) that differ by one edit, in both orders."""
    filters = words.sparkSession.sparkContext.broadcast(bloom_filters(words))
    spread = words.select("word", "n").repartition(1 + words.count() // TASK_WORDS)
    probed = spread.mapInArrow(Probe(filters), "edit string, word string, n long, deleted boolean")
    exact = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    # A word deletes a letter of a double in two ways; a replacement is found from both sides.
    met = stored(probed.distinct().join(exact, "edit"), "spelling-near")
    filters.destroy()
    forth = met.select("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n"))
    back = met.where("deleted").select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return forth.unionAll(back)


def variants(docs: DataFrame, least: int = 5, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row for each word that occurs ``least`` times in the runs of ``docs``.

    ``docs`` needs doc_id and text; other columns are left behind.  Null and
    empty texts have no words; a null id counts as the empty text in the hash
    that sets typos; repeated rows count as often as they occur; texts and runs
    of any length are taken whole.  Of near words with equal n the first in code
    point order is the form.  An empty table gives no rows.
    """
    words = stored(vocabulary(docs, least), "spelling-words")
    # Largest n, then smallest text, each an aggregate of its own: hash aggregation, whose buffers have a fixed size.
    near = stored(near_words(words), "spelling-pairs")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("best_n"))
    first = near.join(best, "word").where("near_n = best_n").groupBy("word", "n_near", "best_n").agg(F.min("near").alias("best"))
    has_form = F.col("best_n") >= times * F.col("n")
    table = stored(
        words.join(first, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return table.join(roots(table), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(table: DataFrame) -> DataFrame:
    """(word, root) of the words with a form; each round doubles the steps taken, and n grows with every step, so it ends."""
    now = table.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        now = stored(step, "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")
