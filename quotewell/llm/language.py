"""Language identification by compression with per-language dictionaries.

A language is a zstandard raw-content dictionary: pieces of its training texts
put one after the other.  A text is compressed once with each dictionary, and
the language whose dictionary makes it smallest is the answer; sizes in bits are
code lengths, so the score is the share of the best one in 2 ** -bits, tempered.
Where the margin over the second is narrow the answer is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quotewell.llm.common import in_slices

LETTER = regex.compile(r"\p{L}")
#: No answer: the text is null or has no letter, or nothing was learnt.
UNDETERMINED = "und"
#: Code points of a piece of training text, and pieces of a dictionary: at most about 128,000 code points per language.
PIECE, PIECES = 500, 256
#: A long text is compressed in parts of so many bytes, lest its own beginning replaces the dictionary.
PART = 4096
#: Before each part: it always compresses, so that a short part is never stored raw at the same size for all languages.
FILLER = b"\n" * 64
#: Bytes that halve the weight of a language against the best one.
HALVING = 2.0
#: Scores below are rejected: the margin to the other languages is narrow.
LEAST_SCORE = 0.75


def pieces_of(text: str) -> list[str]:
    """The whole lower-cased text in pieces of ``PIECE`` code points."""
    text = text.lower()
    return [text[at : at + PIECE] for at in range(0, len(text), PIECE)]


@dataclass(frozen=True)
class SamplePieces:
    """(lang, text) to each language's ``pieces`` distinct pieces of smallest hash, of what the task reads."""

    pieces: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[int, str]] = {}
        limits: dict[str, int] = {}
        for batch in in_slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine, limit = kept.setdefault(lang, {}), limits.get(lang, 1 << 63)
                for piece in pieces_of(text):
                    h = xxhash.xxh3_64_intdigest(piece) >> 1
                    if h < limit:
                        mine[h] = piece
                if len(mine) > 4 * self.pieces:
                    limits[lang] = self.cut(mine)
        for lang, mine in kept.items():
            self.cut(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(mine), pa.string()), pa.array(list(mine), pa.int64()), pa.array(list(mine.values()), pa.string())],
                names=["lang", "hash", "piece"],
            )

    def cut(self, mine: dict[int, str]) -> int:
        for h in sorted(mine)[self.pieces :]:
            del mine[h]
        return max(mine) if len(mine) == self.pieces else 1 << 63


@dataclass(frozen=True)
class LanguageModel:
    """Raw dictionary contents by language, the language of most training rows first."""

    contents: dict[str, bytes] = field(default_factory=dict)

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for content in self.contents.values():
            params = zstandard.ZstdCompressionParameters(
                format=zstandard.FORMAT_ZSTD1_MAGICLESS, window_log=18, hash_log=17, chain_log=17, search_log=4,
                min_match=4, strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_dict_id=0,
            )
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=params))
        return out


def learn(rows: DataFrame, pieces: int = PIECES) -> LanguageModel:
    """Dictionaries from the rows (lang, text) whose two columns are not null.

    A dictionary holds the ``pieces`` distinct pieces of its language's whole
    training texts that have the smallest hash, a bounded uniform sample.  Equal
    pieces count once, so that copies don't fill it.  Each task keeps as many
    of its own before they are compared across tasks.  Memory is ``pieces`` *
    ``PIECE`` code points per language, for a closed set of languages.
    """
    known = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    order = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    ranked = (
        known.mapInArrow(SamplePieces(pieces), "lang string, hash long, piece string")
        .dropDuplicates(["lang", "hash"])
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash")))
        .where(F.col("rank") <= pieces)
    )
    found: dict[str, list[tuple[int, str]]] = {}
    for r in ranked.collect():  # at most ``pieces`` a language
        found.setdefault(r["lang"], []).append((r["hash"], r["piece"]))
    # Texts that are all white space or shorter than a match say nothing, and zstandard takes no dictionary below 8 bytes.
    contents = {lang: " ".join(p for _, p in sorted(found[lang])).encode() for lang in sorted(found, key=lambda k: (-order[k], k))}
    return LanguageModel({lang: content for lang, content in contents.items() if len(content) >= 8})


@dataclass(frozen=True)
class Identify:
    """Appends language, score and whether it is rejected, for the text in column ``at``."""

    model: LanguageModel
    at: int
    names: tuple[str, str, str]
    least_score: float

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, compressors = list(self.model.contents), self.model.compressors()
        for batch in in_slices(batches):
            answers = [self.answer(text, languages, compressors) for text in batch.column(self.at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([a[0] for a in answers], pa.string()),
                    pa.array([a[1] for a in answers], pa.float64()),
                    pa.array([a[1] < self.least_score for a in answers], pa.bool_()),
                ],
                names=[*batch.schema.names, *self.names],
            )

    def answer(self, text: str | None, languages: list[str], compressors: list[zstandard.ZstdCompressor]) -> tuple[str, float]:
        if text is None or not languages or not LETTER.search(text):
            return UNDETERMINED, 0.0
        data = f" {text.lower()} ".encode()  # a dictionary has words with their spaces
        parts = [FILLER + data[at : at + PART] for at in range(0, len(data), PART)]
        sizes = np.array([sum(len(c.compress(p)) for p in parts) for c in compressors], float)
        best = int(sizes.argmin())
        return languages[best], float(1 / np.exp2(np.maximum((sizes[best] - sizes) / HALVING, -1000)).sum())


def identify(
    docs: DataFrame, model: LanguageModel, names: tuple[str, str, str] = ("language", "language_score", "rejected"),
    text_column: str = "text", least_score: float = LEAST_SCORE,
) -> DataFrame:
    """``docs`` with language, score (0 to 1) and rejected (score below ``least_score``) appended; the caller picks free names.

    Every text is read whole, alone and in its own row: no shuffle, and equal
    texts get equal answers.  A null text, one without a letter, and every text
    when nothing was learnt is ``und`` with score 0, rejected.  Where sizes are
    equal the language of more training rows wins, then the first by name; its
    score is then at most a half.  An empty table stays empty, and extra
    columns pass through under any name.
    """
    added = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()))]
    return docs.mapInArrow(Identify(model, docs.columns.index(text_column), names, least_score), T.StructType([*docs.schema.fields, *added]))
