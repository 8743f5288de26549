"""Similarity join of documents on word shingles with adaptive multi-match prefixes.

Documents of equal shingle sets are folded first.  Shingles have one global
order, by hash.  If two sets are similar enough, then the prefixes of both, as
long as the set may have shingles outside the other plus l, share at least l
shingles.  So all but l - 1 of a prefix's shingles suffice as keys, and the most
frequent ones can be left out.

Everyone starts with a small l and one shared key.  A document whose keys would
yield more than ``COST`` candidates is not probed; its prefix is lengthened and
more shared keys are asked for before a pair is verified, up to the whole set
ordered by frequency.  With k shared keys asked for, the candidates are
estimated as the meetings of the keys over k.  A cheap document is probed against
all documents of its level, so each pair is found at the level of the cheaper one,
and no key that is probed has more than ``COST`` * k + 1 documents.

What is dear to the end belongs to families of near copies, or to documents that
are mostly one passage.  There every key's documents are first compared with one
document of another component, twice.  Those left are then described by their
differences from their key's most typical set, the pivot: two sets differ exactly
by where their differences differ, so sets that aren't both linked with the pivot
need common differences, the more the larger their differences are.  The same
prefixes over differences, which are few and mostly rare, give the pairs that are
left; a set whose rare differences alone forbid any link meets nobody.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotewell.llm.common import batches_of, bit_map, in_slices, release, stored, texts
from quotewell.llm.graph import components
from quotewell.llm.shingles import WordHashes, blank_words, shingle_hashes

#: Candidates a document may have at a level before its prefix is lengthened.
COST = 64
#: Shingles the prefixes share at each level, as parts of the set (1.0: the whole set), and shared keys asked for.
START, LEVELS = 0.04, ((0.2, 2), (1.0, 4))
#: Bits of the map that tells which texts' whole sets are wanted; its size is fixed.
MAP_BITS = 24
SKETCH_BITS = 1024
#: Bytes of an Arrow batch: of pairs with whole sets, 10,000 rows would be 60 MB, and more with longer texts.
BATCH = 4 << 20
#: Rounds in which large families are joined before pairs are compared.
STAR_ROUNDS = 2
#: Common differences asked for before two sets of a family are compared, where a link takes so many.
DIFFERENCES = 4


@dataclass(frozen=True)
class Rule:
    """Shingles of ``size`` words; sets link if 100 * intersection >= ``percent`` * union."""

    size: int
    percent: int

    def outside(self, n: int) -> int:
        """How many of ``n`` shingles a linked set may lack."""
        return n - -(-self.percent * n // 100)

    def prefix(self, n: int, part: float) -> int:
        return n if part >= 1 else min(n, self.outside(n) + max(1, -int(-part * n // 1)))

    def keys(self, n: int, part: float) -> int:
        """How many of the prefix's rarest shingles are keys."""
        if part >= 1:
            return self.outside(n) + 1
        smallest = -(-self.percent * n // 100)  # a linked set has at least so many shingles
        return self.prefix(n, part) - (self.prefix(smallest, part) - self.outside(smallest)) + 1

    def prefix_of(self, n: Column, part: float) -> Column:
        """``prefix`` of a column."""
        if part >= 1:
            return n
        return F.least(n, n - self.least_of(n) + F.greatest(F.lit(1), F.ceil(F.lit(part) * n)))

    def keys_of(self, n: Column, part: float) -> Column:
        """``keys`` of a column."""
        if part >= 1:
            return n - self.least_of(n) + 1
        smallest = self.least_of(n)
        return self.prefix_of(n, part) - (self.prefix_of(smallest, part) - smallest + self.least_of(smallest)) + 1

    def share_of(self, n: Column, part: float, most: int) -> Column:
        """How many keys a linked set shares at least, up to ``most``, where so many more of them are kept."""
        smallest = self.least_of(n)
        held = smallest if part >= 1 else self.prefix_of(smallest, part) - smallest + self.least_of(smallest)
        return F.greatest(F.lit(1), F.least(F.lit(most), held)).cast("long")

    def least_of(self, n: Column) -> Column:
        """How many shingles a set that links has at least."""
        return F.floor((self.percent * n + 99) / 100)

    def distinct(self, words: list[str], known: WordHashes) -> np.ndarray:
        return np.unique(shingle_hashes(known.of(words), self.size))

    def linked(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.percent * (a + b - both)


@dataclass(frozen=True)
class Prefixes:
    """(doc_id, doc_hash, text) to (doc_id, doc_hash, n, sid, prefix at the start)."""

    rule: Rule

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known = WordHashes()
        for batch in in_slices(batches):
            sizes, ids, prefixes = [], [], []
            for text in batch.column(2).to_pylist():
                s = self.rule.distinct(blank_words(text), known)
                sizes.append(len(s))
                ids.append(set_id(s) if len(s) else None)
                prefixes.append(s[: self.rule.prefix(len(s), START)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "doc_hash", "n", "sid", "prefix"],
            )


def set_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


@dataclass(frozen=True)
class Sets:
    """(doc_id, doc_hash, text) to (doc_id, doc_hash, n, sketch, shingles) for hashes in the map: whole sets, packed."""

    rule: Rule
    wanted: bytes

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known = WordHashes()
        present = np.unpackbits(np.frombuffer(self.wanted, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            hit = present[batch.column(1).to_numpy() & ((1 << MAP_BITS) - 1)]
            for part in in_slices(iter([batch.filter(pa.array(hit))])):
                sets = [self.rule.distinct(blank_words(text), known) for text in part.column(2).to_pylist()]
                packed = [pa.array(map(sketch, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(map(len, sets), pa.int64()), *packed],
                    names=["doc_id", "doc_hash", "n", "sketch", "shingles"],
                )


def sketch(s: np.ndarray) -> bytes:
    bits = np.zeros(SKETCH_BITS, np.uint8)
    bits[(s & np.uint64(SKETCH_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


@dataclass(frozen=True)
class Lengthened:
    """(sid, n, shingles) to (sid, n, prefix) of the length at this level."""

    rule: Rule
    part: float

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            lengths = [self.rule.prefix(n, self.part) for n in batch.column(1).to_pylist()]
            prefixes = [np.frombuffer(s, np.int64)[:m] for s, m in zip(batch.column(2).to_pylist(), lengths)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prefixes, pa.list_(pa.int64()))], names=["sid", "n", "prefix"]
            )


@dataclass(frozen=True)
class Near:
    """(a, b, na, nb, sketch a, sketch b): pairs whose sketches don't rule a link out; bits that differ are shingles of one set only."""

    rule: Rule

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 4096):
            maps = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64) for i in (4, 5)]
            apart = np.bitwise_count(maps[0] ^ maps[1]).sum(axis=1, dtype=np.int64)
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            keep = (100 + self.rule.percent) * apart <= (100 - self.rule.percent) * both
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))


@dataclass(frozen=True)
class Linked:
    """(a, b, shingles of a, shingles of b) to the pairs that link."""

    rule: Rule

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(self.rule.linked(both, len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def keys_of(prefixes: DataFrame, rule: Rule, part: float, share: int) -> DataFrame:
    """(sid, n, m, share, token, df, cost, one) of the keys that more than one set has, for (sid, n, prefix): the rarest of the prefix.

    m is how many of the set's n shingles another set may have at all, share how
    many keys two linked sets have in common (the less of theirs, at most
    ``share``), cost how many candidates are to be expected.  Where one common key
    is to do, the rows with ``one`` suffice.
    """
    tokens = prefixes.select("sid", "n", F.explode("prefix").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # shingles that no other set has come first in the order, and meet nobody
    mine = Window.partitionBy("sid")
    alone = rule.prefix_of(F.col("n"), part) - F.col("shared")
    ranked = (
        tokens.join(common.hint("merge"), "token")
        .withColumn("rank", F.row_number().over(mine.orderBy("df", "token")))
        .withColumn("shared", F.count("*").over(mine))
        .withColumn("share", rule.share_of(F.col("n"), part, share))
        .withColumn("spare", F.col("rank") - rule.keys_of(F.col("n"), part) + alone)
        .withColumn("key", F.col("spare") < F.col("share"))
        .withColumn("cost", F.sum(F.when(F.col("key"), F.col("df") - 1)).over(mine) / F.col("share"))
    )
    return ranked.where("key").select("sid", "n", (F.col("n") - alone).alias("m"), "share", "token", "df", "cost", (F.col("spare") <= 0).alias("one"))


def may_link(rule: Rule) -> Column:
    """Whether sizes and shingles that others may have allow columns a and b (sid, n, m) to link."""
    sizes = 100 * F.least("a.n", "b.n") >= rule.percent * F.greatest("a.n", "b.n")
    enough = (100 + rule.percent) * F.least("a.m", "b.m") >= rule.percent * (F.col("a.n") + F.col("b.n"))
    return sizes & enough & (F.col("a.sid") != F.col("b.sid"))


def may_share(rule: Rule) -> Column:
    """Whether columns a and b (sid, excess, shared) can have as many common differences as a link takes."""
    most = 2 * (100 + rule.percent) * F.least("a.shared", "b.shared")
    return (most >= F.col("a.excess") + F.col("b.excess")) & (F.col("a.sid") != F.col("b.sid"))


def as_pairs(met: DataFrame, fits: Column) -> DataFrame:
    """(a, b), the smaller first, of the rows with structs a and b that may link."""
    return met.where(fits).select(F.least("a.sid", "b.sid").alias("a"), F.greatest("a.sid", "b.sid").alias("b"))


def set_of(name: str, *columns: str) -> Column:
    return F.struct("sid", *columns).alias(name)


def counted(met: DataFrame, fits: Column) -> DataFrame:
    """(a, b) of the pairs in ``met`` (structs a and b with share, one row for each common key) with as many common keys as both ask for."""
    pairs = met.where(fits).select(
        F.least("a.sid", "b.sid").alias("a"), F.greatest("a.sid", "b.sid").alias("b"), F.least("a.share", "b.share").alias("share"), "token"
    )
    # a pair of two cheap sets is met from both sides
    return pairs.distinct().groupBy("a", "b").agg(F.count("*").alias("common"), F.min("share").alias("share")).where("common >= share").select("a", "b")


def probed(keys: DataFrame, rule: Rule, cost: int, share: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of the cheap sets with all of the level, and the sids of the dear ones."""
    few = keys.where(F.col("df") <= cost * share + 1)
    side = lambda s: set_of(s, "n", "m", "share")
    met = few.where(F.col("cost") <= cost).select("token", side("a")).join(few.select("token", side("b")), "token")
    pairs = as_pairs(met, may_link(rule)).distinct() if share == 1 else counted(met, may_link(rule))
    return pairs, keys.where(F.col("cost") > cost).select("sid").distinct()


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The ``pairs`` (a, b) that link: sketches rule most others out before whole sets are compared."""
    side = lambda s, *columns: sets.select(F.col("sid").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in columns))
    near = (
        pairs.join(side("a", "n", "sketch"), "a")
        .join(side("b", "n", "sketch"), "b")
        .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        .mapInArrow(Near(rule), "a long, b long")
    )
    return (
        near.join(side("a", "shingles"), "a")
        .join(side("b", "shingles"), "b")
        .select("a", "b", "shingles_a", "shingles_b")
        .mapInArrow(Linked(rule), "a long, b long")
    )


class Links:
    """Links found so far, and the component of each linked set; renewed only where there are new links."""

    def __init__(self, edges: DataFrame):
        self.renew(edges)

    def renew(self, edges: DataFrame) -> None:
        self.edges = edges
        self.of = stored(components(edges).withColumnRenamed("node", "sid"), "components")

    def add(self, new: DataFrame) -> None:
        if not new.isEmpty():
            self.renew(self.edges.unionAll(new))

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` (sid) with their component; what has no link is its own."""
        return rows.join(self.of, "sid", "left").withColumn("component", F.coalesce("component", "sid"))


def open_keys(keys: DataFrame, links: Links, typical: Column, columns: tuple[str, ...]) -> DataFrame:
    """The rows of ``keys`` (token, sid, columns) whose key is in two components, with theirs and the key's two most typical sets of different ones."""
    labelled = stored(links.labelled(keys), "labelled")
    best = F.max(F.struct(typical.alias("typical"), "sid", *columns, "component"))
    first = labelled.groupBy("token").agg(best.alias("first"))
    others = labelled.join(first, "token")
    second = others.where(F.col("component") != F.col("first.component")).groupBy("token").agg(best.alias("second"))
    return others.join(second, "token")


def stars(keys: DataFrame, links: Links, typical: Column, columns: tuple[str, ...], fits: Column) -> DataFrame:
    """Pairs (a, b) of every set with one of another component for each of its keys; linear in the keys."""
    rows = open_keys(keys, links, typical, columns)
    a = [rows.where(F.col("component") != F.col(f"{s}.component")).select(set_of("a", *columns), F.col(s).alias("b")) for s in ("first", "second")]
    return as_pairs(a[0].unionAll(a[1]), fits).distinct()


def families(keys: DataFrame, sets: DataFrame, links: Links, rule: Rule) -> None:
    """Adds to ``links`` those among the sets of ``keys`` (token, sid, n, m) that join two components.

    Rounds of stars join what is alike.  The sets of keys still open are then
    keyed by their differences from the key's most typical set; once more a round
    of stars, and the pairs across components with enough common differences are
    compared one by one.
    """

    def verify(pairs: DataFrame) -> None:
        if not pairs.isEmpty():
            links.add(stored(verified(pairs, sets, rule), "links"))

    typical, columns = F.col("m") / F.col("n"), ("n", "m")
    tried = None
    for _ in range(STAR_ROUNDS):
        met = stars(keys, links, typical, columns, may_link(rule))
        new = stored(met if tried is None else met.join(tried, ["a", "b"], "left_anti"), "met")
        tried = new if tried is None else tried.unionAll(new)
        verify(new)
    rows = open_keys(keys, links, typical, columns).select(F.col("first.sid").alias("pivot"), "sid").where("pivot <> sid")
    apart = stored(differences(rows.distinct(), sets, rule), "apart")
    if apart.isEmpty():
        return
    # the sets linked with a pivot that isn't in their component yet
    near = links.labelled(apart.where("linked").select("pivot", "sid"))
    pivots = links.labelled(near.select(F.col("pivot").alias("sid")).distinct()).select(F.col("sid").alias("pivot"), F.col("component").alias("other"))
    near = near.join(pivots, "pivot").where("component <> other")
    links.add(stored(near.select(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b")), "links"))

    keys = stored(difference_keys(apart, rule), "family")
    least_apart, columns = -F.col("excess"), ("excess", "shared", "share")
    verify(stored(stars(keys.where("one").drop("one", "pivot"), links, least_apart, columns, may_share(rule)), "met"))
    # what is left: pairs of different components with as many common keys as both ask for
    rows = open_keys(keys, links, least_apart, columns)
    least = F.when(F.col("component") != F.col("first.component"), F.col("first.excess")).otherwise(F.col("second.excess"))
    hopeful = 2 * (100 + rule.percent) * F.col("shared") >= F.col("excess") + least
    left = stored(rows.where(hopeful).select("token", set_of("a", *columns, "component")), "left")
    met = left.join(left.select("token", F.col("a").alias("b")), "token")
    apart_only = (F.col("a.sid") < F.col("b.sid")) & (F.col("a.component") != F.col("b.component"))
    verify(stored(counted(met, may_share(rule) & apart_only), "met"))


@dataclass(frozen=True)
class Differences:
    """(pivot, sid, shingles of both) to (pivot, sid, excess, linked, size and tokens of the difference)."""

    rule: Rule

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more, less = 100 + self.rule.percent, 100 - self.rule.percent
        for batch in in_slices(batches):
            excess, linked, tokens = [], [], []
            for p, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, x = np.frombuffer(p, np.int64), np.frombuffer(x, np.int64)
                apart = np.setxor1d(p, x, assume_unique=True)
                excess.append(more * len(apart) - less * len(x))
                linked.append(excess[-1] <= less * len(p))
                tokens.append(apart)
            sizes = pa.array(map(len, tokens), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(excess, pa.int64()), pa.array(linked, pa.bool_()), sizes, pa.array(tokens, pa.list_(pa.int64()))],
                names=["pivot", "sid", "excess", "linked", "size", "tokens"],
            )


def differences(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(pivot, sid, excess, linked, size, tokens) for ``pairs`` (pivot, sid).

    With p percent, two sets link if (100 + p) times what they differ by is at
    most (100 - p) times the sum of their sizes.  ``excess`` is (100 + p) times
    the difference from the pivot less (100 - p) times the own size, so two sets
    link exactly if 2 * (100 + p) times their common differences is at least
    the sum of their excesses.
    """
    side = lambda s: sets.select(F.col("sid").alias(s), F.col("shingles").alias(f"of_{s}"))
    both = pairs.join(side("sid"), "sid").join(side("pivot"), "pivot").select("pivot", "sid", "of_pivot", "of_sid")
    return both.mapInArrow(Differences(rule), "pivot long, sid long, excess long, linked boolean, size long, tokens array<long>")


def difference_keys(apart: DataFrame, rule: Rule) -> DataFrame:
    """(token, pivot, sid, excess, shared, share, one): the rarest differences of each set, per pivot, as ``keys_of`` gives for shingles.

    Sets whose excesses add up to nothing or less are both linked with the pivot.
    All others have common differences, at least as many as the excess asks for
    together with the least excess of the pivot's sets.
    """
    key = F.xxhash64("pivot", "token").alias("token")
    least = apart.groupBy("pivot").agg(F.min("excess").alias("least"))
    tokens = apart.select("pivot", "sid", "excess", F.explode("tokens").alias("token")).select("pivot", "sid", "excess", key)
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    mine = Window.partitionBy("pivot", "sid")
    need = F.greatest(F.lit(1), F.ceil((F.col("excess") + F.col("least")) / (2 * (100 + rule.percent)))).cast("long")
    ranked = (
        tokens.join(common.hint("merge"), "token")
        .withColumn("rank", F.row_number().over(mine.orderBy("df", "token")))
        .withColumn("shared", F.count("*").over(mine))
        .join(least, "pivot")
        .withColumn("need", need)
        .withColumn("share", F.least(F.lit(DIFFERENCES), F.col("need")))
        .withColumn("spare", F.col("rank") - (F.col("shared") - F.col("need") + 1))
    )
    # fewer common differences than needed: the set links with nobody else of the pivot
    keys = ranked.where("shared >= need AND spare < share")
    return keys.select("token", "pivot", "sid", "excess", "shared", "share", (F.col("spare") <= 0).alias("one"))


def similarity_components(docs: DataFrame, size: int = 4, percent: int = 85, cost: int = COST) -> DataFrame:
    """(doc_id, doc_hash, n_shingles, component_id) for each row of ``docs``.

    A document is the set of its distinct shingles of ``size`` words (at most
    five; all its words if it has fewer), hashed to 64 bits; two documents link
    if 100 * intersection >= ``percent`` * union.  ``component_id`` is the
    smallest doc_id reachable, nulls aside.  Null, empty and blank texts have no
    shingles and are alone, as is their id.  Repeated rows and ids are documents
    of their own, linked if not empty.  Texts are read whole; other columns are
    left behind.
    """
    with batches_of(docs.sparkSession, BATCH):
        return grouped(docs, Rule(size, percent), cost)


def grouped(docs: DataFrame, rule: Rule, cost: int) -> DataFrame:
    """What ``similarity_components`` returns; all Python work is done when it does."""
    rows = texts(docs).withColumn("doc_hash", F.xxhash64("text"))
    base = stored(
        rows.select("doc_id", "doc_hash", "text").mapInArrow(
            Prefixes(rule), "doc_id long, doc_hash long, n long, sid long, prefix array<long>"
        ),
        "prefixes",
    )
    some = base.where("sid IS NOT NULL")
    first = some.select("sid", "n", "prefix").dropDuplicates(["sid"])
    keys = stored(keys_of(first, rule, START, 1), "keys")
    pairs, dear = probed(keys, rule, cost, 1)
    pairs, dear = stored(pairs, "pairs"), stored(dear, "dear")

    named = some.groupBy("sid").agg(F.min(F.struct("doc_id", "doc_hash")).alias("doc"))
    met = pairs.select(F.explode(F.array("a", "b")).alias("sid"), F.lit(False).alias("dear"))
    wanted = met.unionAll(dear.select("sid", F.lit(True).alias("dear"))).groupBy("sid").agg(F.max("dear").alias("dear"))
    wanted = named.join(wanted, "sid").select("sid", "dear", F.col("doc.doc_id").alias("id"), F.col("doc.doc_hash").alias("hash"))
    wanted = stored(wanted, "wanted")
    place = F.col("hash").bitwiseAND(F.lit((1 << MAP_BITS) - 1)).alias("p")
    shared = docs.sparkSession.sparkContext.broadcast(Sets(rule, bit_map(wanted.select(place), MAP_BITS)))
    whole = rows.select("doc_id", "doc_hash", "text").mapInArrow(
        lambda batches: shared.value(batches), "doc_id long, doc_hash long, n long, sketch binary, shingles binary"
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("doc_hash") == F.col("hash"))
    once = whole.join(wanted.hint("merge"), same).dropDuplicates(["doc_id", "doc_hash", "sid"])
    sets = stored(once.select("sid", "n", "sketch", "shingles", "dear"), "sets")

    some_dear = not dear.isEmpty()
    longer = sets.where("dear")
    for part, share in LEVELS if some_dear else ():
        prefixes = longer.select("sid", "n", "shingles").mapInArrow(Lengthened(rule, part), "sid long, n long, prefix array<long>")
        keys = stored(keys_of(prefixes, rule, part, share), "keys")
        more, dear = probed(keys, rule, cost, share)
        pairs, dear = pairs.unionAll(stored(more, "pairs")), stored(dear, "dear")
        longer = sets.join(dear, "sid", "left_semi")
    links = Links(stored(verified(pairs.distinct(), sets, rule), "links"))
    if some_dear:
        families(stored(keys.where("one").join(dear, "sid", "left_semi").select("token", "sid", "n", "m"), "family"), sets, links, rule)

    least = links.labelled(some.groupBy("sid").agg(F.min("doc_id").alias("least")))
    least = stored(least, "sets-of")
    named = least.join(least.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("sid", "component_id")
    return (
        base.select("doc_id", "doc_hash", "sid", "n")
        .join(named, "sid", "left")
        .select("doc_id", "doc_hash", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )
