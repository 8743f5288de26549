"""Phrase collocations: contiguous runs of words counted through double-array tries of Apriori-safe candidates.

Texts become blocks of word codes once.  Then, for two, three and four words:

1. A sketch counts hashes of the runs whose shorter runs are frequent, as far as
   bit maps of a fixed size tell, in buckets; a run in a bucket below the
   threshold can't reach it (Apriori).
2. The distinct runs of the remaining buckets are the candidates; blocks take
   turns in naming them, so that a run isn't named by every task.
3. Candidates are cut into tries of bounded size.  Each is broadcast in turn; its
   states advance for all positions of a block at once, and the accepting
   states' bincounts are summed over all blocks.  Only exact counts decide.

Tables of frequent phrases stay in Spark, where cuts are scored and parts dropped.
Words are told apart by 64-bit hashes while counting.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotewell.llm.bits import bit_words, has_bit
from quotewell.llm.common import in_slices, stored
from quotewell.llm.double_array import DoubleArray
from quotewell.llm.shingles import MULTIPLIERS, mixed

#: A to Z in lower case; a mark that ends a piece becomes a byte that UTF-8 has not, which then stands as a word of its own.
BREAK = b"\xff"
TABLE = bytes(
    BREAK[0] if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
MAX_SEEN = 300_000
#: Windows whose hashes are counted together in a task.
CHUNK = 1 << 21
#: One of so many blocks that hold a run names it as a candidate at first.
RATE = 8
#: Counts that are shuffled and summed as one array.
COUNTS = 1024
#: Candidates of one trie, about 100 MB at most.
TRIE_ROWS = 400_000


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, pieces ended by BREAK."""
    return text.translate(TABLE).replace(BREAK, b" \xff ").split()  # what bytes.split() takes as white space are separators here


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang)) or 1


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` values."""
    count = max(len(values) - size + 1, 0)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += values[k : k + count] * MULTIPLIERS[k]
    return mixed(total + np.uint64(size))


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to partial (lang, word, n); a null word has the number of all words."""
    counts: dict[str, Counter] = {}
    for batch in in_slices(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            counts.setdefault(lang, Counter()).update(tokens_of(text))
        if sum(map(len, counts.values())) > MAX_SEEN:
            yield from flush(counts)
    yield from flush(counts)


def flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, found in counts.items():
        found.pop(BREAK, None)
        words, n = [None, *found], [found.total(), *found.values()]
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()), pa.array(n[at : at + 20_000], pa.int64())],
                names=["lang", "word", "n"],
            )
    counts.clear()


@dataclass(frozen=True)
class Encode:
    """(lang, text) to blocks of one language: its distinct frequent words, and where they stand, 0 where a run must end."""

    frequent: Broadcast
    bits: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            rows = [(lang, *self.block(lang.encode(), tokens_of(b"\n".join(texts)))) for lang, texts in by_lang.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.binary(), pa.binary()))],
                names=["lang", "words", "hashes", "tokens"],
            )

    def block(self, lang: bytes, tokens: list[bytes]) -> tuple[bytes, bytes, bytes]:
        place: dict[bytes, int] = {}
        found = np.fromiter((place.setdefault(t, len(place)) for t in tokens), np.int64, len(tokens))
        hashes = np.fromiter((0 if w == BREAK else word_hash(lang, w) for w in place), np.uint64, len(place))
        known = has_bit(self.frequent.value, hashes & np.uint64((1 << self.bits) - 1)) & (hashes != 0)
        codes = np.where(known, np.cumsum(known), 0)[found] if len(place) else found
        # A word alone between two ends is in no run, and one end is enough.
        before, after = np.concatenate([[0], codes[:-1]]), np.concatenate([codes[1:], [0]])
        codes = np.where((before > 0) | (after > 0), codes, 0)
        codes = codes[(codes > 0) | (np.concatenate([[1], codes[:-1]]) > 0)]
        return b" ".join(compress(place, known)), hashes[known].tobytes(), codes.astype(code_type(int(known.sum()))).tobytes()


def code_type(words: int) -> type:
    return np.uint16 if words < 1 << 16 else np.uint32


@dataclass(frozen=True)
class Windows:
    """The runs of ``size`` words of a block, by hash, that may be frequent: all words known, both shorter runs in the bit map."""

    size: int
    shorter: Broadcast | None
    bits: int

    def of(self, hashes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the runs."""
        values = np.concatenate([[np.uint64(0)], hashes])[tokens]
        count = max(len(tokens) - self.size + 1, 0)
        good = np.ones(count, bool)
        for k in range(self.size):
            good &= tokens[k : k + count] > 0
        if self.shorter is not None:
            parts = has_bit(self.shorter.value, window_hashes(values, self.size - 1) & np.uint64((1 << self.bits) - 1))
            good &= parts[:count] & parts[1 : count + 1]
        at = np.flatnonzero(good)
        return at, window_hashes(values, self.size)[at]


def blocks_of(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(row, hashes, tokens, batch) of each block, its hashes in column ``first`` and its tokens in the next."""
    for batch in batches:
        for row in range(batch.num_rows):
            hashes = np.frombuffer(batch.column(first)[row].as_buffer(), np.uint64)
            yield row, hashes, np.frombuffer(batch.column(first + 1)[row].as_buffer(), code_type(len(hashes))), batch


@dataclass(frozen=True)
class Sketch:
    """(hashes, tokens) to partial counts (p, n) of the buckets p of the runs' hashes."""

    windows: Windows

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, hashes, tokens, _ in blocks_of(batches, 0):
            held.append(self.windows.of(hashes, tokens)[1] & np.uint64((1 << self.windows.bits) - 1))
            if sum(map(len, held)) > CHUNK:
                yield from self.counted(held)
        yield from self.counted(held)

    def counted(self, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if held:
            places, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(places.view(np.int64)), pa.array(n, pa.int64())], names=["p", "n"])
        held.clear()


@dataclass(frozen=True)
class Candidates:
    """(lang, words, hashes, tokens) to runs whose bucket is set, once a task.

    Only one of ``rate`` blocks that hold a run names it, drawn by hashes of the
    run and the block.
    """

    windows: Windows
    buckets: Broadcast
    rate: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for row, hashes, tokens, batch in blocks_of(batches, 2):
            at, found = self.windows.of(hashes, tokens)
            passing = has_bit(self.buckets.value, found & np.uint64((1 << self.windows.bits) - 1))
            passing &= mixed(found + hashes.sum(dtype=np.uint64)) % np.uint64(self.rate) == 0
            found, first = np.unique(found[passing], return_index=True)
            new = np.fromiter((h not in seen for h in found.tolist()), bool, len(found))
            if len(seen) > MAX_SEEN:
                seen.clear()
            seen.update(found[new].tolist())
            begin = at[passing][first[new]]
            words = batch.column(1)[row].as_py().decode().split(" ")
            runs = zip(*((tokens[begin + k].astype(np.int64) - 1).tolist() for k in range(self.windows.size)))
            phrases = [" ".join(map(words.__getitem__, run)) for run in runs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)[row].as_py()] * len(phrases), pa.string()), pa.array(phrases, pa.string())], names=["lang", "phrase"]
            )


@dataclass(frozen=True)
class HashRuns:
    """(lang, phrase) with the hashes of its words (w0, w1, ...) and the place p of the run's hash in a map."""

    size: int
    bits: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = [x.encode() for x in batch.column(0).to_pylist()]
            words = [p.split(b" ") for p in batch.column(1).cast(pa.binary()).to_pylist()]
            hashes = np.array([word_hash(lang, w) for lang, ws in zip(langs, words) for w in ws], np.uint64).reshape(-1, self.size)
            runs = mixed((hashes * MULTIPLIERS[: self.size]).sum(1, dtype=np.uint64) + np.uint64(self.size))
            columns = [hashes[:, k].copy() for k in range(self.size)] + [runs & np.uint64((1 << self.bits) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c.view(np.int64)) for c in columns)],
                names=["lang", "phrase", *(f"w{k}" for k in range(self.size)), "p"],
            )


@dataclass(frozen=True)
class Count:
    """(hashes, tokens) to the task's bincount of the trie's rows, in chunks (chunk, counts) that are not all zero."""

    trie: Broadcast

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie: DoubleArray = self.trie.value
        totals = np.zeros(-(-len(trie.ids) // COUNTS) * COUNTS, np.int32)  # a task has fewer than 2 ** 31 words
        for _, hashes, tokens, _ in blocks_of(batches, 0):
            codes = np.concatenate([[len(trie.words)], trie.encoded(hashes)])
            totals[: len(trie.ids)] += trie.counts(codes[tokens])
        chunks = totals.reshape(-1, COUNTS)
        there = np.flatnonzero(chunks.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array([chunks[k].tobytes() for k in there], pa.binary())], names=["chunk", "counts"]
        )


def sum_counts(ids: Broadcast) -> Callable[[tuple, pa.Table], pa.Table]:
    """All tasks' counts of one chunk to (id, n)."""

    def summed(key: tuple, group: pa.Table) -> pa.Table:
        begin = key[0].as_py() * COUNTS
        own = ids.value[begin : begin + COUNTS]
        total = np.zeros(COUNTS, np.int64)
        for counts in group["counts"]:
            total += np.frombuffer(counts.as_buffer(), np.int32)
        return pa.table({"id": pa.array(own), "n": pa.array(total[: len(own)])})

    return summed


def sketch_bits(words: int) -> int:
    """Bits of the maps: four words or fewer to a bucket, up to 2 ** 27 buckets (16 MB); a fuller map only passes more candidates."""
    return min(27, max(16, (words // 4).bit_length()))


def counted(candidates: DataFrame, coded: DataFrame, size: int, trie_rows: int) -> DataFrame:
    """``candidates`` (id, w0, w1, ...) with the number n of their occurrences in ``coded``: a trie of bounded size after the other."""
    spark = candidates.sparkSession
    shards = max(1, -(-candidates.count() // trie_rows))
    sums = []
    for shard in range(shards):
        part = candidates.where(F.pmod("id", F.lit(shards)) == shard).select("id", *(f"w{k}" for k in range(size))).toArrow()
        if part.num_rows:
            ids, *words = (c.to_numpy() for c in part.columns)
            built = DoubleArray.build(np.stack(words, 1).view(np.uint64), ids)
            trie, order = spark.sparkContext.broadcast(built), spark.sparkContext.broadcast(built.ids)
            shards_of_counts = coded.mapInArrow(Count(trie), "chunk int, counts binary").groupBy("chunk")
            sums.append(stored(shards_of_counts.applyInArrow(sum_counts(order), "id long, n long"), "phrase-counts"))
            trie.destroy()
            order.destroy()
    if not sums:
        return candidates.withColumn("n", F.lit(0).cast("long"))
    return candidates.join(reduce(DataFrame.unionAll, sums), "id")


def frequent_phrases(
    docs: DataFrame, min_count: int, longest: int = 4, trie_rows: int = TRIE_ROWS, rate: int = RATE
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, n) of all phrases of 1 to ``longest`` words that occur ``min_count`` times, (lang, n) of all words).

    ``docs`` has (lang, text).  Every table is stored; the driver holds bit maps
    of at most 16 MB and one trie of at most ``trie_rows`` candidates at a time.

    Candidates of a size are named in two rounds.  First one of ``rate`` blocks
    with a run names it, which finds nearly all.  Once they are counted, their
    counts are taken off the sketch: a frequent run not yet named leaves its
    bucket at the threshold or above, and of such buckets every block names all.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = stored(
        rows.mapInArrow(word_counts, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= min_count) | F.col("word").isNull()),
        "phrase-words",
    )
    totals = words.where("word IS NULL").select("lang", "n")
    levels = [words.where("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n")]
    bits = sketch_bits(totals.agg(F.sum("n")).first()[0] or 0)

    def bit_map(places: DataFrame) -> Broadcast:
        return spark.sparkContext.broadcast(bit_words(places.select("p"), 1 << (bits - 6)))

    def hashed(phrases: DataFrame, size: int) -> DataFrame:
        longs = ", ".join(f"w{k} long" for k in range(size))
        return phrases.select("lang", "phrase").mapInArrow(HashRuns(size, bits), f"lang string, phrase string, {longs}, p long")

    word_place = F.col("w0").bitwiseAND(F.lit((1 << bits) - 1)).alias("p")
    frequent = bit_map(hashed(levels[0], 1).select(word_place))
    blocks = stored(rows.mapInArrow(Encode(frequent, bits), "lang string, words binary, hashes binary, tokens binary"), "phrase-blocks")
    frequent.destroy()
    coded = blocks.select("hashes", "tokens")
    shorter = None
    for size in range(2, longest + 1):
        windows = Windows(size, shorter, bits)
        sketch = coded.mapInArrow(Sketch(windows), "p long, n long").groupBy("p").agg(F.sum("n").alias("n"))
        left = stored(sketch.where(F.col("n") >= min_count), "phrase-sketch")
        known = None
        for share in dict.fromkeys((rate, 1)):
            buckets = bit_map(left)
            found = blocks.mapInArrow(Candidates(windows, buckets, share), "lang string, phrase string").distinct()
            if known is not None:
                found = found.join(known.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
            candidates = stored(hashed(found, size).withColumn("id", F.monotonically_increasing_id()), "phrase-candidates")
            buckets.destroy()
            level = stored(counted(candidates, coded, size, trie_rows), "phrase-level")
            known = level if known is None else known.unionByName(level)
            taken = level.groupBy("p").agg(F.sum("n").alias("taken"))
            left = left.join(taken, "p", "left").select("p", (F.col("n") - F.coalesce("taken", F.lit(0))).alias("n")).where(F.col("n") >= min_count)
        level = known.where(F.col("n") >= min_count)
        levels.append(level.select("lang", "phrase", F.lit(size).alias("size"), "n"))
        if shorter is not None:
            shorter.destroy()
        shorter = bit_map(level)
    shorter.destroy()
    return reduce(DataFrame.unionAll, levels), totals


def part_of(words: str, start, length):
    """Text of some words of the array column ``words``."""
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, longest: int = 4, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words by their weakest cut.

    ``docs`` needs lang and text; other columns are left behind.  A null lang
    counts as ``und``, with rows of that very name; a null or empty text has no
    words; equal rows count as often as they occur.  Texts of any length are read
    whole.  Ties in score and count are broken by the phrase's bytes.  A language
    without a frequent phrase, and an empty table, has no rows.
    """
    table, totals = frequent_phrases(docs, min_count, longest, trie_rows)
    table = stored(table, "phrase-table")
    long = table.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = long.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "cut", F.col("n").alias("a"),
        part_of("words", F.lit(1), F.col("cut")).alias("first"),
        part_of("words", F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"),
    )
    left = table.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = table.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr("(cast(2000000 AS decimal(7, 0)) * cast(a AS decimal(19, 0))) div (cast(l AS decimal(19, 0)) + r)")
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("weakest"))
    )
    parts = (
        long.where("size > 2")
        .withColumn("of", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("of") + 1)))
        .groupBy("lang", part_of("words", F.col("at"), F.col("of")).alias("phrase"))
        .agg(F.max("n").alias("longer"))
    )
    kept = scored.join(parts, ["lang", "phrase"], "left").where(
        "longer IS NULL OR 100 * cast(longer AS decimal(19, 0)) < 80 * cast(a AS decimal(19, 0))"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("weakest.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "weakest.l", "weakest.r", "n",
        F.col("weakest.score").cast("long").alias("score"),
    )
