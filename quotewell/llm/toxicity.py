"""Toxicity by a weighted finite-state grammar over clauses, with a lexicon and weights learnt from labels.

Five small transducers read the words of a clause at once: insults, threats,
targets, negation and reported speech.  A word's class comes from a lexicon.
Insulting terms, whole words and word beginnings, are learnt from the labelled
documents: counted over all their distinct texts in Spark, all kept that are much
more frequent in toxic ones.  The grammar composes the transducers' states into the
weight of a clause: an insult or threat counts in full, more with a target, and
little when a negation governs it or the clause reports another's words.  What
a document's clauses add up to goes through a logistic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.common import in_slices, release, stored, texts

WORDS = re.compile(r"[^\W\d_]+")
#: A clause ends at a mark of punctuation or at a line's end; the apostrophe and the hyphen are inside words.
CLAUSE = re.compile(r"[.!?;:,()\[\]{}\"\n\r…–—]+")

# Closed word classes of the four languages of the corpus.
NEGATIONS = frozenset(
    "not never no neither nor without nicht nie niemals kein keine keinen ohne pas jamais aucun aucune sans nunca "
    "jamás ningún ninguna sin tampoco".split()
)
REPORTS = frozenset(
    "said says say told wrote writes called calls claimed reported quoted sagte sagt schrieb nannte behauptete dit "
    "disait écrivait appelait dijo dice escribió llamó afirmó".split()
)
TARGETS = frozenset(
    "you your yours youre they them their she her him his du dich dir dein deine ihr euch sie ihn tu toi ton ta vous "
    "votre ils elles lui tú ti tu usted ustedes ellos ellas vosotros".split()
)
THREATS = frozenset(
    "kill hurt burn beat shoot stab destroy hang töten umbringen schlagen verbrennen erschießen tuer frapper brûler "
    "détruire matar golpear quemar destruir".split()
)

#: How much of a weight remains under negation and under report, and what a target adds.
NEGATED, REPORTED, AIMED = 0.25, 0.4, 1.5
THREAT_WEIGHT = 2.0
#: Words after which a negation no longer governs.
REACH = 3


@dataclass(frozen=True)
class Grammar:
    """The composed transducer: insulting words and beginnings with their weights, and the closed classes."""

    words: dict[str, float]
    beginnings: dict[str, float]
    beginning_lengths: tuple[int, ...] = field(default=())

    def insult(self, word: str) -> float:
        weight = self.words.get(word, 0.0)
        for n in self.beginning_lengths:
            if len(word) > n:
                weight = max(weight, self.beginnings.get(word[:n], 0.0))
        return weight

    def clause(self, words: list[str], weights: dict[str, float]) -> tuple[float, int]:
        """Weight and number of matches of one clause.

        The state is (words left under negation, reported, aimed); each word
        moves it and may emit a weight, and the accepting state scales the sum.
        """
        governed, reported, aimed, total, matched = 0, False, False, 0.0, 0
        for word in words:
            weight = weights.get(word, 0.0)
            if not weight and word in THREATS:
                weight = THREAT_WEIGHT
            if weight:
                total += weight * (NEGATED if governed else 1.0)
                matched += 1
            if word in NEGATIONS:
                governed = REACH
            elif governed:
                governed -= 1
            if word in REPORTS:
                reported = True
            elif word in TARGETS:
                aimed = True
        if aimed:
            total *= AIMED
        return total * (REPORTED if reported else 1.0), matched

    def document(self, text: str, seen: dict[str, float]) -> tuple[float, int, int]:
        """(sum of clause weights, matched clauses, words).  ``seen`` keeps weights of words between calls."""
        lowered = text.lower()
        words = WORDS.findall(lowered)
        for word in set(words).difference(seen):
            seen[word] = self.insult(word)
        if not any(map(seen.__getitem__, set(words))) and THREATS.isdisjoint(words):
            return 0.0, 0, len(words)
        total, clauses = 0.0, 0
        for part in CLAUSE.split(lowered):
            weight, matched = self.clause(WORDS.findall(part), seen)
            total += weight
            clauses += matched > 0
        return total, clauses, len(words)


@dataclass(frozen=True)
class ToxicityModel:
    """Grammar and logistic coefficients of (1, log1p of the weight, log1p of the weight per 100 words)."""

    grammar: Grammar
    coefficients: tuple[float, ...]

    def score(self, text: str, seen: dict[str, float]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(features(self.grammar, text, seen), self.coefficients))))))


def features(grammar: Grammar, text: str, seen: dict[str, float]) -> list[float]:
    total, clauses, words = grammar.document(text, seen)
    return [1.0, math.log1p(total), math.log1p(100 * total / max(words, 20)), math.log1p(clauses)]


#: Lengths of the word beginnings that are counted beside whole words.
BEGINNINGS = (4, 5, 6, 7)
MAX_SEEN = 300_000


def word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, text_hash) to (doc_id, text_hash, distinct words): all that counting needs, and less to shuffle than the text."""
    release()
    for batch in in_slices(batches):
        bags = [" ".join(set(WORDS.findall(text.lower()))) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(bags, pa.string())], names=["doc_id", "text_hash", "words"]
        )


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial document counts of words and beginnings ("abcd*") by label, for (words, toxic) rows."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in in_slices(batches):
        for words, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            terms = words.split()
            counts[toxic].update(terms)
            counts[toxic].update({f"{w[:n]}*" for w in terms for n in BEGINNINGS if len(w) > n})
        if len(counts[0]) + len(counts[1]) > MAX_SEEN:
            yield from flush(counts)
    yield from flush(counts)


def flush(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    terms = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(terms), 20_000):
        part = terms[at : at + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string())] + [pa.array([c[t] for t in part], pa.int64()) for c in counts],
            names=["term", "clean", "toxic"],
        )
    for c in counts:
        c.clear()


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the ids that have exactly one distinct toxic label of 0 or 1."""
    return (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most")
        .select("doc_id", "toxic")
    )


def learn(
    docs: DataFrame, labels: DataFrame, min_toxic: int = 5, min_odds: float = 20.0, sample: int = 20_000
) -> ToxicityModel:
    """Grammar and coefficients from the documents that ``labels`` (doc_id, toxic) names.

    Term counts cover every labelled document, equal texts of one label once;
    only its distinct words are shuffled to its label.  Every term is kept that at
    least ``min_toxic`` toxic texts hold and whose odds there are ``min_odds``
    times those elsewhere.  There are at most as many as the distinct terms of
    toxic texts, over ``min_toxic``, counted per text; driver and workers hold
    them all.
    The four coefficients are fitted on a sample of at most ``sample`` documents
    of each label, by the smallest hash of the id.
    """
    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    known = stored(known_labels(labels).join(rows.select("doc_id").distinct(), "doc_id"), "toxic-labels")
    one_of_each = stored(
        rows.select("doc_id", "text_hash")
        .join(known.hint("merge"), "doc_id")  # labels grow with the corpus: the same plan at every size
        .groupBy("text_hash", "toxic")
        .agg(F.min("doc_id").alias("doc_id")),
        "toxic-texts",
    )
    totals = {r["toxic"]: r["n"] for r in one_of_each.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not toxic or not clean:  # one label only: its share, which is 0 or 1, or a half for no rows at all
        return ToxicityModel(Grammar({}, {}), (4.0 if toxic else -4.0 if clean else 0.0, 0.0, 0.0, 0.0))
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    terms = (
        rows.mapInArrow(word_sets, "doc_id long, text_hash long, words string")
        .join(one_of_each.hint("merge"), ["doc_id", "text_hash"])
        .dropDuplicates(["doc_id", "text_hash"])  # repeated rows
        .select("words", "toxic")
        .mapInArrow(term_counts, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= min_toxic) & (odds >= min_odds))
        .select("term", F.log(odds).alias("weight"))
        .collect()
    )
    found = {r["term"]: min(r["weight"], 6.0) / 3 for r in terms}
    beginnings = {t[:-1]: w for t, w in found.items() if t.endswith("*")}
    grammar = Grammar(
        {t: w for t, w in found.items() if not t.endswith("*")}, beginnings, tuple(sorted({len(b) for b in beginnings}))
    )
    picked = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (0, 1)]
    measured = (
        rows.join(F.broadcast(picked[0].unionAll(picked[1])), "doc_id")  # at most 2 x sample rows
        .select("doc_id", "text", "toxic")
        .mapInArrow(Measure(grammar), "toxic int, x array<double>")
    )
    fitted = measured.collect()
    return ToxicityModel(grammar, fit([r["x"] for r in fitted], [r["toxic"] for r in fitted]))


@dataclass(frozen=True)
class Measure:
    grammar: Grammar

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: dict[str, float] = {}
        for batch in in_slices(batches):
            if len(seen) > MAX_SEEN:
                seen.clear()
            x = [features(self.grammar, t, seen) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"]
            )


def fit(rows: list[list[float]], labels: list[int], ridge: float = 1.0, steps: int = 25) -> tuple[float, ...]:
    """Ridge logistic regression by Newton's method; both labels weigh as often as they occur."""
    x, y = np.array(rows, dtype=float), np.array(labels, dtype=float)
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


@dataclass(frozen=True)
class Score:
    """Appends the score of the text in column ``at``."""

    model: ToxicityModel
    at: int
    name: str

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: dict[str, float] = {}
        for batch in in_slices(batches):
            if len(seen) > MAX_SEEN:
                seen.clear()
            scores = [self.model.score(t or "", seen) for t in batch.column(self.at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, self.name]
            )


def score(docs: DataFrame, model: ToxicityModel, name: str = "score", text_column: str = "text") -> DataFrame:
    """``docs`` with the column ``name``, from 0 to 1, appended; the caller picks a name that ``docs`` has not.

    Null and empty texts score as documents without a match.  Every row is
    scored alone, so repeated rows and ids get equal scores; an empty table
    stays empty.  A text of any length is read whole.  Without labels of both
    kinds the score is 0.98, 0.02 or a half for all.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(Score(model, docs.columns.index(text_column), name), schema)
