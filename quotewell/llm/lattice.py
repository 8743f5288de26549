"""Language-model scores of documents: words seen in training, all others by a subword lattice.

The pieces are those of a public subword vocabulary.  A word's spelling
probability is the sum over all ways to cut it into pieces, by a forward
recursion in log space; characters outside the vocabulary go byte by byte.  The
scores of the pieces come from the distinct training words.  Beside its pieces
the lattice of a word has one arc for the word as a whole, if it was seen: its
discounted share of the training tokens.  What the discount leaves is spread
over all words, mostly by their spelling, so probabilities add up to at most one.

A word that the document already has is likelier to come again: shares are those
of a Polya urn that starts with ``CONCENTRATION`` words drawn from the model and
gets each word of the document in turn.  The order of words doesn't matter then,
so counts are enough.

Word shares are kept for each of a few classes of training documents, such as
languages.  A document's class is never read when it is scored: its probability
is the sum over the classes, just as it is over the segmentations.

Words are the unit that is shuffled, not documents.  A block of documents turns
into one row per distinct word with a posting list; rows are joined to the
word's count and score, go back to their block, and are added up there.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import in_slices, stored

#: Tokens and documents in a block; a posting packs the document's place in it and up to 4095 occurrences.
BLOCK_TOKENS, BLOCK_DOCS = 8_000_000, 1 << 20
SPACE, MAX_PIECE = "▁", 16
#: Most classes of training documents; the rarer ones share the last.
CLASSES = 8
#: Of what the discount leaves, the part that goes to words seen in other classes.
ELSEWHERE = 0.1
#: Words of the model that the urn starts with.
CONCENTRATION = 4000.0
BLOCK_ROW = "block long, word string, postings binary, trained array<long>, doc_id long, held_out boolean, class int, n_tokens long"


@dataclass(frozen=True)
class Postings:
    """(doc_id, held_out, class, text) to rows of words with postings, and of documents, for each block."""

    classes: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        block = Block(number, self.classes)
        for batch in in_slices(batches):
            for doc_id, held_out, kind, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                block.add(doc_id, held_out, kind, words_of(text))
                if block.tokens >= BLOCK_TOKENS or len(block.docs) >= BLOCK_DOCS:
                    yield from block.rows()
                    number += 1
                    block = Block(number, self.classes)
        if block.docs:
            yield from block.rows()


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space in UTF-8, A to Z in lower case: bytes.split() takes just these characters for white space."""
    return text.encode().translate(LOWER_BYTES).split()


class Block:
    def __init__(self, number: int, classes: int) -> None:
        self.number, self.classes, self.tokens = number, classes, 0
        self.ids: dict[bytes, int] = {}
        self.docs: list[tuple[int | None, bool, int, int]] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, held_out: bool, kind: int, words: list[bytes]) -> None:
        ids, place = self.ids, len(self.docs)
        counts = Counter(words)
        word = np.fromiter([ids.setdefault(w, len(ids)) for w in counts], np.int64, len(counts))
        count = np.fromiter(counts.values(), np.int64, len(counts))
        self.docs.append((doc_id, held_out, kind, len(words) + 1))
        self.tokens += len(words) + 1
        while len(word):
            self.pairs.append((word.astype(np.uint32), (place << 12 | np.minimum(count, 4095)).astype(np.uint32)))
            more = count > 4095
            word, count = word[more], count[more] - 4095

    def rows(self) -> Iterator[pa.RecordBatch]:
        n = len(self.ids)
        if n:
            word = np.concatenate([w for w, _ in self.pairs]).astype(np.int64)
            posting = np.concatenate([p for _, p in self.pairs])
            order = np.argsort(word, kind="stable")
            word, posting = word[order], posting[order]
            ends = np.searchsorted(word, np.arange(n + 1))
            kinds = np.array([self.classes if held else kind for _, held, kind, _ in self.docs])[posting >> 12]
            cells = n * (self.classes + 1)
            trained = np.bincount(word * (self.classes + 1) + kinds, posting & 4095, cells).astype(np.int64).reshape(n, -1)
            packed, names = posting.astype("<u4").tobytes(), list(self.ids)
            for at in range(0, n, 20_000):
                to = min(n, at + 20_000)
                yield self.batch(
                    names[at:to], [packed[4 * ends[k] : 4 * ends[k + 1]] for k in range(at, to)], trained[at:to, :-1].tolist(), *[[None] * (to - at)] * 4
                )
        for at in range(0, len(self.docs), 20_000):
            part = self.docs[at : at + 20_000]
            places = np.arange(at, at + len(part), dtype="<u4").tobytes()
            yield self.batch([None] * len(part), [places[4 * k : 4 * k + 4] for k in range(len(part))], [None] * len(part), *map(list, zip(*part)))

    def batch(self, *columns: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.bool_(), pa.int32(), pa.int64())
        rows = [[self.number] * len(columns[0]), *columns]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=[f.split()[0] for f in BLOCK_ROW.split(", ")])


@dataclass(frozen=True)
class PieceCounts:
    """(word) to partial counts of (piece) in the vocabulary's own segmentation of distinct words."""

    vocabulary: str

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model, counts = sentencepiece.SentencePieceProcessor(model_file=self.vocabulary), Counter()
        for batch in in_slices(batches, 10_000):
            for pieces in model.encode(batch.column(0).to_pylist(), num_threads=1):
                counts.update(pieces)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.id_to_piece(i) for i in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["piece", "n"]
        )


LOWER_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
NO_PIECE = -1  # never a log probability: an integer, told apart by identity


def with_beginnings(pieces: dict[str, float]) -> dict[str, float | None]:
    beginnings = {p[:k]: None for p in pieces for k in range(1, len(p))}
    return beginnings | pieces


@dataclass(frozen=True)
class Lattice:
    """Log probabilities of pieces that begin and that go on a word, of single bytes, of going on and of stopping."""

    begin: dict[str, float]
    inner: dict[str, float]
    byte: tuple[float, ...]
    stop: float
    #: The same with the beginnings of pieces, at None, so that a walk along a word ends where no piece goes on.
    walk: dict[str, float | None] = field(init=False, repr=False)
    begin_walk: dict[str, float | None] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "walk", with_beginnings(self.inner))
        object.__setattr__(self, "begin_walk", with_beginnings(self.begin))

    @staticmethod
    def of(pieces: list[str], counts: dict[str, int], words: int, smooth: float = 0.01) -> Lattice:
        """Scores from ``counts`` of pieces in the spellings of ``words`` words."""
        begin = {p[1:]: counts.get(p, 0) + smooth for p in pieces if p.startswith(SPACE) and SPACE not in p[1:]}
        begin.setdefault("", smooth)
        inner = {p: counts.get(p, 0) + smooth for p in pieces if SPACE not in p and not (p.startswith("<") and p.endswith(">") and len(p) > 2)}
        byte = [counts.get(f"<0x{b:02X}>", 0) + smooth for b in range(256)]
        all_begin, all_inner = sum(begin.values()), sum(inner.values()) + sum(byte)
        stop = (words + smooth) / (words + all_inner + smooth)
        go = math.log(1 - stop) - math.log(all_inner)
        return Lattice(
            {p: math.log(c / all_begin) for p, c in begin.items() if len(p) <= MAX_PIECE},
            {p: math.log(c) + go for p, c in inner.items() if len(p) <= MAX_PIECE},
            tuple(math.log(c) + go for c in byte),
            math.log(stop),
        )

    def log_probability(self, word: str) -> float:
        """Natural log of the sum over all segmentations of ``word``."""
        n, walk = len(word), self.walk
        incoming: list[list[float]] = [[] for _ in range(n + 1)]
        incoming[0].append(self.begin[""])
        for k in range(1, min(n, MAX_PIECE) + 1):
            score = self.begin_walk.get(word[:k], NO_PIECE)
            if score is NO_PIECE:
                break
            if score is not None:
                incoming[k].append(score)
        for i in range(n):
            ways = incoming[i]
            if not ways:
                continue
            if len(ways) == 1:
                here = ways[0]
            elif len(ways) == 2:
                here = max(ways) + math.log1p(math.exp(-abs(ways[0] - ways[1])))
            else:
                top = max(ways)
                here = top + math.log(sum([math.exp(w - top) for w in ways]))
            single = walk.get(word[i])
            if single is None or single is NO_PIECE:
                incoming[i + 1].append(here + sum([self.byte[b] for b in word[i].encode("utf-8", "surrogatepass")]))
            for k in range(i + 1, min(n, i + MAX_PIECE) + 1):
                score = walk.get(word[i:k], NO_PIECE)
                if score is NO_PIECE:
                    break
                if score is not None:
                    incoming[k].append(here + score)
        top = max(incoming[n])
        return top + math.log(sum([math.exp(w - top) for w in incoming[n]])) + self.stop


@dataclass(frozen=True)
class Share:
    """Tokens and distinct words of one class of training documents (or of all), and the discount of its counts."""

    tokens: int
    distinct: int
    discount: float

    @staticmethod
    def of(tokens: int, distinct: int, once: int, twice: int) -> Share:
        return Share(tokens, distinct, (once + 0.5) / (once + 2 * twice + 1))

    def seen(self, c: int) -> float:
        return (c - self.discount) / self.tokens if c else 0.0

    @property
    def rest(self) -> float:
        return self.discount * self.distinct / self.tokens


@dataclass(frozen=True)
class WordScores:
    """(word, counts by class) to (word, c, scores): log10 of the model's probability in each class, as packed floats."""

    lattice: Lattice
    tokens: int
    distinct: int
    whole: Share | None
    classes: tuple[Share, ...]

    def base(self, c: int) -> float:
        return math.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def of(self, counts: list[int], spelled: float) -> list[float]:
        """log10 in each class: the word's own share there, and its part of the rest, mostly by its spelling."""
        if self.whole is None:
            return [spelled / math.log(10)]
        others = ELSEWHERE * self.whole.seen(sum(counts)) / max(1e-12, 1 - self.whole.rest)
        spelling = math.log(1 - ELSEWHERE) + spelled
        out = []
        for share, c in zip(self.classes, counts):
            known = share.seen(c) + share.rest * others
            other = math.log(share.rest) + spelling
            if known:
                known = math.log(known)
                other = max(known, other) + math.log1p(math.exp(-abs(known - other)))
            out.append(other / math.log(10))
        return out

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 10_000):
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            scores = [self.of(c, self.lattice.log_probability(w)) for w, c in zip(words, counts)]
            packed = [row.tobytes() for row in np.array(scores, "<f4")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(sum, counts), pa.int64()), pa.array(packed, pa.binary())], names=["word", "c", "scores"]
            )


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - sum(np.log(x + k) for k in range(8))


def rising(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Natural log of x (x + 1) ... (x + n - 1)."""
    return log_gamma(x + n) - log_gamma(x)


@dataclass(frozen=True)
class BlockSums:
    """One block's rows (postings, c, scores, doc_id, held_out, n_tokens) to its documents' sums.

    ``shares`` and ``ends`` are each class's share of documents, and the end token's share of its tokens.
    """

    tokens: int
    distinct: int
    base_end: float
    shares: tuple[float, ...]
    ends: tuple[float, ...]

    def __call__(self, table: pa.Table) -> pa.Table:
        is_doc = table["n_tokens"].is_valid().to_numpy()
        docs, words = table.filter(pa.array(is_doc)), table.filter(pa.array(~is_doc))
        places = np.frombuffer(b"".join(docs["postings"].to_pylist()), "<u4").astype(np.int64)
        size, classes = int(places.max()) + 1, len(self.ends)
        sums = np.zeros((2 + classes, size))
        for chunk in words.to_batches(max_chunksize=50_000):
            blobs = chunk.column("postings").to_pylist()
            posting = np.frombuffer(b"".join(blobs), "<u4")
            row = np.repeat(np.arange(len(blobs)), [len(b) // 4 for b in blobs])
            place, count = posting >> 12, (posting & 4095).astype(np.float64)
            c = chunk.column("c").to_numpy(zero_copy_only=False)
            base = np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))
            scores = np.frombuffer(b"".join(chunk.column("scores").to_pylist()), "<f4").astype(np.float64).reshape(-1, classes)
            for k, value in enumerate((c > 0, base)):
                sums[k] += np.bincount(place, count * value[row], size)
            # a count over 4095 is several postings in a row: occurrences before each
            at = np.arange(len(place))
            follows = np.zeros(len(place), bool)
            follows[1:] = (place[1:] == place[:-1]) & (row[1:] == row[:-1])
            before = 4095.0 * (at - np.maximum.accumulate(np.where(follows, 0, at)))
            for k in range(classes):
                value = math.log(CONCENTRATION / (1 - self.ends[k])) + math.log(10) * scores[row, k]
                again = np.exp(value) + before
                value = np.where(before > 0, np.log(np.maximum(again, 1.0)), value)
                many = count > 1
                value[many] += rising(again[many] + 1, count[many] - 1)
                sums[2 + k] += np.bincount(place, value, size)
        n_known, base, *by_class = sums[:, places]
        n_words = docs["n_tokens"].to_numpy() - 1.0
        urn = np.where(n_words > 0, rising(np.full(len(n_words), CONCENTRATION), n_words), 0.0)
        ends = np.array(self.ends)[:, None]
        by_class = (np.array(by_class) - urn + n_words * np.log1p(-ends) + np.log(np.array(self.shares)[:, None] * ends)) / math.log(10)
        top = by_class.max(axis=0)
        score = top + np.log10((10.0 ** (by_class - top)).sum(axis=0))
        return pa.table(
            {
                "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": docs["n_tokens"],
                "n_known": np.rint(n_known).astype(np.int64) + (self.tokens > 0),
                "train_tokens": np.full(docs.num_rows, self.tokens),
                "base_score": base + self.base_end, "score": score,
            }
        )


def score(docs: DataFrame, vocabulary: str, held_out: str, class_column: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    ``held_out`` is an SQL condition on doc_id; the model learns from the other
    rows.  ``vocabulary`` is a file of subword pieces, whose number bounds what
    reaches the driver.  ``class_column`` divides the training rows; null is a
    class like others.  Null and empty texts are the end token alone.  Repeated
    rows and ids are scored, and learnt from, as often as they occur.  Without
    training rows words are scored by an untrained lattice alone, and the base
    gives every token the same probability.  An empty table gives no rows.
    """
    import sentencepiece

    condition = F.coalesce(F.expr(held_out), F.lit(False))
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.col(class_column).cast("string") if class_column else F.lit("")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).select("doc_id", condition.alias("held_out"), F.coalesce("kind", F.lit("")).alias("kind"), "text")
    common = given.where("NOT held_out").groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").limit(CLASSES).collect()
    place = F.lit(CLASSES - 1)
    for k, r in enumerate(common):
        place = F.when(F.col("kind") == r["kind"], k).otherwise(place)
    classes = max(1, len(common))
    rows = given.select("doc_id", "held_out", F.least(place, F.lit(classes - 1)).cast("int").alias("class"), "text")
    blocks = stored(rows.mapInArrow(Postings(classes), BLOCK_ROW), "postings")
    each = [F.sum(F.col("trained")[k]).alias(f"c{k}") for k in range(classes)]
    counts = blocks.where("word IS NOT NULL").groupBy("word").agg(*each)
    counts = stored(counts.select("word", F.array(*(f"c{k}" for k in range(classes))).alias("counts")), "words")
    ends = {r["class"]: r["n"] for r in blocks.where("word IS NULL AND NOT held_out").groupBy("class").agg(F.count("*").alias("n")).collect()}
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    statistics = []
    for c in (total, *(F.col("counts")[k] for k in range(classes))):
        statistics += [F.coalesce(F.sum(c), F.lit(0)), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)]
    found = list(counts.agg(*[s.alias(f"s{i}") for i, s in enumerate(statistics)]).first())
    rows_of = [found[4 * k : 4 * k + 4] for k in range(classes + 1)]
    used = [k for k in range(classes) if ends.get(k)]
    all_ends = sum(ends.values())
    tokens, distinct = rows_of[0][0] + all_ends, rows_of[0][1] + (all_ends > 0)
    whole = Share.of(tokens, distinct, *rows_of[0][2:]) if all_ends else None
    shares = tuple(Share.of(rows_of[k + 1][0] + ends[k], rows_of[k + 1][1] + 1, *rows_of[k + 1][2:]) for k in used)

    pieces = counts.where(total > 0).select("word").mapInArrow(PieceCounts(vocabulary), "piece string, n long")
    seen = {r["piece"]: r["n"] for r in pieces.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    lattice = Lattice.of([model.id_to_piece(i) for i in range(model.get_piece_size())], seen, rows_of[0][1])
    scores = WordScores(lattice, tokens, distinct, whole, shares)
    of_docs_in = tuple(ends[k] / all_ends for k in used) or (1.0,)
    of_ends = tuple(s.seen(ends[k]) for k, s in zip(used, shares)) or (math.exp(lattice.stop),)
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    wanted = F.array(*(F.col("counts")[k] for k in used or [0])).alias("counts")
    known = counts.select("word", wanted).mapInArrow(
        lambda batches: shared.value(batches), "word string, c long, scores binary"
    )
    of_words = blocks.where("word IS NOT NULL").select("block", "word", "postings").join(known.hint("merge"), "word")
    no_doc = [F.lit(None).cast(t).alias(n) for n, t in (("doc_id", "long"), ("held_out", "boolean"), ("n_tokens", "long"))]
    no_word = [F.lit(None).cast(t).alias(n) for n, t in (("c", "long"), ("scores", "binary"))]
    of_docs = blocks.where("word IS NULL").select("block", "postings", *no_word, "doc_id", "held_out", "n_tokens")
    sums = BlockSums(tokens, distinct, scores.base(all_ends), of_docs_in, of_ends)
    return (
        of_words.select("block", "postings", "c", "scores", *no_doc)
        .unionAll(of_docs)
        .groupBy("block")
        .applyInArrow(
            lambda table: sums(table),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
