"""Hierarchical packing of documents into token windows of several lengths.

Every document is cut into whole windows of the longest tier as far as it goes;
the rest is routed to the shortest tier that holds it.  Tiers are packed from
the longest down: a rest opens a window of its tier, and what the window still
lacks is filled from the rests of the same and of shorter tiers, the longest one
that fits first, cutting one only where none fits.  Hence every window is full
to its tier's length; only what is left over at the very end of a task is cut
into ever shorter powers of two.  Full windows are dealt to step groups such
that each group of a task gets nearly the same attention cost.

A task packs the rows that it reads, in chunks of bounded size, so nothing is
shuffled, no task depends on another, and a lost task is simply run again.
"""

from __future__ import annotations

import heapq
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.common import in_slices, kept, texts

TIERS = (256, 512, 1024, 2048)
#: Pieces of (document, start, length) in the order in which they lie in a window.
Piece = tuple[int, int, int]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("step_group", T.LongType()),
    ]
)
#: ASCII marks that may follow a word and then form one pre-token of their own; the apostrophe is not among them.
TRAILING = ",.!?;:#$%&*)]}-"
#: Chunks after which a worker's cache of ids drops its older half.
CACHED = 600_000


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder(dict):
    """Ids of blank-free chunks as packed little-endian uint32, each computed when first met, in a cache of bounded size.

    The tokenizer's pre-tokens never cross white space, and a word of Latin
    letters followed by ASCII marks is two pre-tokens, so ids of chunks are ids
    of the text.  The normaliser only lower-cases such a word, which hence goes
    straight to the tokenizer's model; any other chunk to the whole tokenizer.
    """

    def __init__(self, path: str, cached: int = CACHED) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__({"": b""})
        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.model = self.tokenizer.model
        self.before: dict[str, bytes] = {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(0x80, 0x130) if chr(i).isalpha()}

    @staticmethod
    def plain(word: str) -> bool:
        """Letters that stay one pre-token when normalised: up to U+012F, before the dotted capital I."""
        return word.isalpha() and (word.isascii() or max(word) < "\u0130")

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            word = chunk if chunk.isalpha() else chunk.rstrip(TRAILING)
            if not self.plain(word):
                ids = packed_ids(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
            elif len(word) < len(chunk):
                ids = self[word] + self[chunk[len(word) :]]
            elif word != (lower := word.lower()):
                ids = self[lower]
            else:
                ids = packed_ids([t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.letters))])
        self[chunk] = ids
        return ids

    def encode(self, batch: list[str]) -> list[bytes]:
        if len(self) > self.cached:  # the older half of the cache goes
            self.before = dict(self)
            self.clear()
            self[""] = b""
        get = self.__getitem__
        return [b"".join(map(get, text.replace("\n", " ").split(" "))) for text in batch]


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process, kept between tasks until an operator that keeps nothing runs there."""
    return kept(f"encoder {path}", lambda: WordEncoder(path))


class Rests:
    """Rests of documents by length; the longest one within a limit is found from one integer's bits."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.lengths = 0

    def add(self, doc: int, start: int, length: int) -> None:
        self.by_length[length].append((doc, start))
        self.lengths |= 1 << length

    def take(self, limit: int) -> Piece | None:
        """The longest rest of at most ``limit`` tokens, or nothing."""
        within = self.lengths & ((1 << (limit + 1)) - 1)
        return self._pop(within.bit_length() - 1) if within else None

    def take_shortest(self) -> Piece | None:
        return self._pop((self.lengths & -self.lengths).bit_length() - 1) if self.lengths else None

    def _pop(self, length: int) -> Piece:
        doc, start = self.by_length[length].pop()
        if not self.by_length[length]:
            self.lengths &= ~(1 << length)
        return doc, start, length


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Windows of pieces for documents of these lengths; see the module's text.

    Every window but those of the final remainder is as long as a tier; the
    remainder's are as long as ever shorter powers of two.
    """
    tiers, rests, windows = tuple(sorted(tiers)), Rests(), []
    longest = tiers[-1]
    for doc, length in enumerate(lengths):
        whole = length - length % longest
        windows += [[(doc, start, longest)] for start in range(0, whole, longest)]
        if whole < length:
            rests.add(doc, whole, length - whole)
    for shorter, tier in reversed(list(zip((0, *tiers), tiers))):
        while rests.lengths >> (shorter + 1):  # rests routed to this tier
            window, room = [], tier
            while room:
                piece = rests.take(room)
                if piece is None:
                    piece = rests.take_shortest()
                    if piece is None:
                        break
                    doc, start, length = piece
                    rests.add(doc, start + room, length - room)
                    piece = doc, start, room
                window.append(piece)
                room -= piece[2]
            windows += [window] if not room else power_windows(window)
    return windows


def power_windows(window: list[Piece]) -> Iterator[list[Piece]]:
    """Cut an under-full window into full ones of falling powers of two."""
    total = sum(length for _, _, length in window)
    pieces = list(reversed(window))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        part = []
        while room:
            doc, start, length = pieces.pop()
            if length > room:
                pieces.append((doc, start + room, length - room))
                length = room
            part.append((doc, start, length))
            room -= length
        yield part


def step_groups(windows: list[list[Piece]], group_tokens: int) -> list[int]:
    """A group for each window: costly windows first, each to the cheapest group that has room for its tokens."""
    totals = [sum(n for _, _, n in window) for window in windows]
    costs = [sum(n * n for _, _, n in window) for window in windows]
    groups = max(1, -(-sum(totals) // group_tokens))
    heap, chosen, used = [(0, g) for g in range(groups)], [0] * len(windows), [0] * groups
    for w in sorted(range(len(windows)), key=lambda w: (-costs[w], w)):
        passed = []
        while True:
            cost, group = heapq.heappop(heap)
            if used[group] + totals[w] <= group_tokens or not heap:
                break
            passed.append((cost, group))
        chosen[w] = group
        used[group] += totals[w]
        heapq.heappush(heap, (cost + costs[w], group))
        for entry in passed:
            if used[entry[1]] < group_tokens:
                heapq.heappush(heap, entry)
        if not heap:
            heap = [(0, g) for g in range(groups)]
    return chosen


@dataclass(frozen=True)
class Packing:
    """Parameters: tokenizer file, id that ends a document, tiers, tokens of a step and of a chunk."""

    tokenizer: str
    end_id: int = 1
    tiers: tuple[int, ...] = TIERS
    group_tokens: int = 32_768
    chunk_tokens: int = 4_000_000

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(self.tokenizer).encode, struct.pack("<I", self.end_id)
        base, docs, size, windows_before, groups_before = TaskContext.get().partitionId() << 33, [], 0, 0, 0
        for batch in in_slices(batches, 256):
            keys, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, ids in zip(keys, encode(bodies)):
                docs.append((key, ids + end))
                size += len(ids) // 4 + 1
            if size >= self.chunk_tokens:
                out, windows_before, groups_before = self.packed(docs, base, windows_before, groups_before)
                yield from out
                docs, size = [], 0
        if docs:
            yield from self.packed(docs, base, windows_before, groups_before)[0]

    def packed(self, docs: list, base: int, window: int, group: int) -> tuple[list[pa.RecordBatch], int, int]:
        windows = pack_lengths([len(ids) // 4 for _, ids in docs], self.tiers)
        groups = step_groups(windows, self.group_tokens)
        columns: list[list] = [[] for _ in SCHEMA]
        for n, pieces in enumerate(windows):
            offset, tier = 0, sum(length for _, _, length in pieces)
            for doc, start, length in pieces:
                key, ids = docs[doc]
                row = (
                    key, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4,
                    base + window + n, offset, tier, base + group + groups[n],
                )
                for column, value in zip(columns, row):
                    column.append(value)
                offset += length
        whole = pa.RecordBatch.from_arrays(
            [
                pa.array(c, {"long": pa.int64(), "binary": pa.binary(), "integer": pa.int32()}[f.dataType.typeName()])
                for c, f in zip(columns, SCHEMA)
            ],
            names=SCHEMA.names,
        )
        return list(in_slices(iter([whole]), 4096)), window + len(windows), group + max(groups) + 1


def pack(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", **parameters: object
) -> DataFrame:
    """Pieces of all documents in packed windows, one row per piece with its ids as packed uint32.

    ``tier`` is the number of tokens in the window, ``sequence_id`` the window,
    ``step_group`` the group of windows that make one training step.

    Null and empty texts are documents of the end id alone.  Repeated rows and
    repeated or null ids are packed as often as they occur.  A very long text
    spans as many windows as it needs.  An empty table has no pieces.  Other
    columns are left behind, so their names cannot clash.
    """
    packing = Packing(tokenizer, **parameters)
    return texts(docs, id_column, text_column).mapInArrow(packing, SCHEMA)


def piece_digest(pieces: DataFrame) -> DataFrame:
    """What names each piece without its ids: their crc32 in place of them."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "tier", "step_group",
    )
