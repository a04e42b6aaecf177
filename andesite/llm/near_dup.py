"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures.

A document's set is its distinct runs of ``WORDS`` words (A-Z lower-cased, split at ASCII blanks);
with fewer words the whole sequence is the one member, without words the set is empty.  Documents
are linked if their sets have a Jaccard similarity of at least ``percent`` per cent (``PERCENT`` unless
given), and the groups are the connected components of the links.

1. Equal sets become one class, found by a 128-bit fingerprint, so exact copies are never paired.  A
   class is named by one of its rows, and only that row's text is read again, for the full set.
2. Every class has a signature of ``SYMBOLS`` minima, 8 bits each.  The first of them are split
   into chunks of 6, each of which gives one key for each symbol that may be wrong; a pair with a
   chunk that differs in at most one symbol shares a key.  ``layout`` takes as many chunks as are
   needed for a pair at the least similarity to share no key with a chance of at most ``MISS``, and
   less above: 7 chunks at 85 per cent, 10 at 80.  By the pigeonhole principle two signatures that
   differ in at most 13 symbols of 7 chunks always share a key.
3. Each key names its smallest class as leader, and the pairs of members and leaders are confirmed:
   first all symbols are compared (at least ``least_equal`` of 128 must be equal, ``DEVIATIONS`` below
   the mean at the least similarity), then the full sets.  Links become components.
4. Only keys that still hold several components are searched further.  In ``ROUNDS`` rounds every
   member proposes, within its key, the most similar member of another component; what is
   confirmed joins components.  This changes no result and saves most of the work of step 5.
5. Within the keys that still hold several components, all pairs of different components are
   compared: by the 128 symbols, then by a sketch of ``SKETCH`` more (at least ``least_sketch`` equal,
   again ``DEVIATIONS`` below the mean).  A pair is proposed in the first key it shares only, and
   each pair that passes is confirmed on full sets.  Pairs within a component are not needed.
6. The components of all links are final.

Nothing is capped: a key with more than ``BLOCK`` members is compared in pairs of blocks, each a group
of its own.  Full sets and sketches are made once, for the classes that share a key.  Texts are joined
with ids only behind a filter of hashed ids of fixed size, so those that share no key are not shuffled.
Data goes to the shared folder between the steps.

Null and empty texts have empty sets, n_shingles 0, are linked with nothing, and are kept.  A null
doc_id is linked with nothing, has a null component and is kept.  Repeated rows get a row each, with
the same values.  A doc_id that repeats with different texts is one document per text: each text has
its own links, they are not linked by the common doc_id, and component_id is the smallest doc_id of the
rows that are linked.  Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from andesite.llm.common import (
    WordHashes, byte_words, key_filter, mix, slices, split_by_filter, stage, window_hashes,
)

WORDS = 5
PERCENT = 85
SYMBOLS, SKETCH = 128, 1024
CHUNK = 6
# The chance that a pair at the least similarity shares no key, and the deviations it may fall below
# the mean in a comparison of symbols.
MISS, DEVIATIONS = 3e-5, 4.7
ROUNDS = 2
BLOCK = 1024
# Hashes handled at once when signatures are computed.
STRIP = 1 << 16
# Characters of text whose full sets are made at once.
SET_SLICE = 2_000_000

_seeds = np.random.default_rng(20240229)
FACTORS = (_seeds.integers(0, 1 << 31, SYMBOLS + SKETCH, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
TERMS = _seeds.integers(0, 1 << 32, SYMBOLS + SKETCH, dtype=np.uint32)
SIGNATURE_SYMBOLS, SKETCH_SYMBOLS = range(SYMBOLS), range(SYMBOLS, SYMBOLS + SKETCH)

PRINT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("mark", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("print1", T.LongType()), T.StructField("print2", T.LongType()),
    T.StructField("signature", T.BinaryType()),
])


class Layout(NamedTuple):
    """What follows from the least similarity: chunks of the keys, equal symbols of the comparisons."""

    percent: int
    chunks: int
    least_equal: int
    least_sketch: int


def layout(percent: int) -> Layout:
    """The layout for a similarity of at least ``percent`` per cent."""
    if not 0 < percent <= 100:
        raise ValueError("the similarity must be above 0 and at most 100 per cent")
    equal = percent / 100 + (1 - percent / 100) / 256
    apart = 1 - equal**CHUNK - CHUNK * equal ** (CHUNK - 1) * (1 - equal)
    chunks = 1
    while apart**chunks > MISS:
        chunks += 1
        if chunks * CHUNK > SYMBOLS:
            raise ValueError(f"{SYMBOLS} symbols are too few for a similarity of {percent} per cent")

    def least(n: int) -> int:
        return round(n * equal - DEVIATIONS * (n * equal * (1 - equal)) ** 0.5)

    return Layout(percent, chunks, least(SYMBOLS), least(SKETCH))


def shingles(text: str | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """The sorted hashes of a text's set."""
    return np.unique(window_hashes(hashes.of(byte_words(text, lower=True)), words))


def signatures(sets: list[np.ndarray], symbols: range = SIGNATURE_SYMBOLS) -> np.ndarray:
    """8-bit MinHash symbols of non-empty sets, one row each."""
    out = np.empty((len(sets), len(symbols)), np.uint32)
    begin = 0
    while begin < len(sets):
        end, size = begin, 0
        while end < len(sets) and (end == begin or size + len(sets[end]) <= STRIP):
            size += len(sets[end])
            end += 1
        values = (np.concatenate(sets[begin:end]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[begin : end - 1])])
        buffer = np.empty_like(values)
        for column, j in enumerate(symbols):
            np.multiply(values, FACTORS[j], out=buffer)
            np.add(buffer, TERMS[j], out=buffer)
            out[begin:end, column] = np.minimum.reduceat(buffer, starts)
        begin = end
    out *= np.uint32(0x9E3779B1)
    return (out >> np.uint32(24)).astype(np.uint8)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Size, fingerprint and signature of each document's set; the latter null for empty sets.

    ``mark`` is a hash of the text, which with the doc_id finds the text again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("mark")
            for begin in range(0, batch.num_rows, 1000):
                texts = batch.column("text").slice(begin, 1000).to_pylist()
                sets = [shingles(t, hashes, words) for t in texts]
                full = [s for s in sets if len(s)]
                signed = iter(signatures(full))
                prints = [
                    (int(s.sum().view(np.int64)), int(mix(s ^ np.uint64(len(s))).sum().view(np.int64)))
                    if len(s) else (None, None) for s in sets
                ]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(begin, 1000).cast(pa.int64()),
                    marks.slice(begin, 1000),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([p for p, _ in prints], pa.int64()),
                    pa.array([p for _, p in prints], pa.int64()),
                    pa.array([next(signed).tobytes() if len(s) else None for s in sets], pa.binary()),
                ], PRINT.names)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, PRINT)


def chunk_keys(signature: str = "signature", chunks: int = layout(PERCENT).chunks) -> Column:
    """Per chunk and symbol that may be wrong: a hash of the chunk's other symbols."""
    keys = []
    for chunk in range(chunks):
        first = chunk * CHUNK + 1
        for wrong in range(CHUNK):
            left = F.substring(signature, first, wrong)
            right = F.substring(signature, first + wrong + 1, CHUNK - 1 - wrong)
            keys.append(F.xxhash64(F.lit(chunk * CHUNK + wrong), left, right))
    return F.array(*keys)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def screen(pairs: DataFrame, classes: DataFrame, least_equal: int) -> DataFrame:
    """The pairs (a, b) with enough equal symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (_matrix(batch.column("sign_a")) == _matrix(batch.column("sign_b"))).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(equal >= least_equal))

    def side(c: str) -> DataFrame:
        return classes.select(F.col("class").alias(c), F.col("signature").alias(f"sign_{c}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


def leader_pairs(keyed: DataFrame) -> DataFrame:
    """Distinct pairs of the smallest class of a key and each other member."""
    leaders = keyed.groupBy("key").agg(F.min("class").alias("a"))
    return keyed.join(leaders, "key").filter("class > a").select("a", F.col("class").alias("b")).distinct()


def block_members(keyed: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the keys that hold several components, once for each pair of blocks they are in."""
    labelled = keyed.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    sizes = labelled.groupBy("key").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("members")
    )
    mixed = sizes.filter("least < most").select("key", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    # A member of block i is in the groups (i, j) and (j, i) of its key.
    return (
        labelled.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("class"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select("class", "label", "key", "slot", "own",
                F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )


class Group:
    """The members of a key in one block, or in two."""

    def __init__(self, rows: pa.Table, limits: Layout):
        self.limits = limits
        self.ids, self.labels, self.own = (rows.column(c).to_numpy() for c in ("class", "label", "own"))
        self.signs = _matrix(rows.column("signature"))
        self.slot = rows.column("slot")[0].as_py()
        self.i, self.j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        return np.flatnonzero(self.own == self.i), np.flatnonzero(self.own == self.j)

    def near(self, x: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The others of another component with enough symbols like those of x, and how many."""
        others = others[self.labels[others] != self.labels[x]]
        equal = np.count_nonzero(self.signs[others] == self.signs[x], axis=1)
        enough = equal >= self.limits.least_equal
        return others[enough], equal[enough]

    def first_shared(self, x: int, others: np.ndarray) -> np.ndarray:
        """The others for which this key is the first that they share with x."""
        chunks = self.limits.chunks
        wrong = (self.signs[others, : chunks * CHUNK] != self.signs[x, : chunks * CHUNK])
        wrong = wrong.reshape(len(others), chunks, CHUNK).sum(2)
        first = (wrong <= 1).argmax(1)
        alike = wrong[np.arange(len(others)), first] == 0
        return others[(first == self.slot // CHUNK) & (~alike | (self.slot % CHUNK == 0))]

    def pairs(self, found: list[tuple[int, np.ndarray]]) -> pa.Table:
        x = np.concatenate([np.full(len(o), self.ids[x]) for x, o in found] or [np.empty(0, np.int64)])
        y = np.concatenate([self.ids[o] for _, o in found] or [np.empty(0, np.int64)])
        return pa.table({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})


def best_pairs(rows: pa.Table, limits: Layout) -> pa.Table:
    """Each member with the most similar one of another component."""
    group = Group(rows, limits)
    left, right = group.sides()
    found = []
    for own, others in [(left, right)] + ([(right, left)] if group.i != group.j else []):
        for x in own:
            near, equal = group.near(x, others)
            if len(near):
                found.append((x, near[[np.argmax(equal)]]))
    return group.pairs(found)


def all_pairs(rows: pa.Table, limits: Layout) -> pa.Table:
    """All pairs of different components that pass both comparisons, in the first key they share."""
    group = Group(rows, limits)
    sketches = _matrix(rows.column("sketch"))
    left, right = group.sides()
    found = []
    for x in left:
        near, _ = group.near(x, right[right > x] if group.i == group.j else right)
        near = group.first_shared(x, near)
        near = near[np.count_nonzero(sketches[near] == sketches[x], axis=1) >= limits.least_sketch]
        if len(near):
            found.append((x, near))
    return group.pairs(found)


def text_key(docs: DataFrame) -> list[Column]:
    """doc_id and mark of the documents, in the types of the fingerprints."""
    return [docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"])]


def repeats_of(rows: DataFrame) -> DataFrame:
    """(doc_id, mark) that several rows have."""
    return rows.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "mark")


def candidate_sets(keyed: DataFrame, prints: DataFrame, docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(class, members, sketch): the full sets of the classes that share a key.

    Only texts of rows that repeat as a whole go through an aggregation; all others are unique already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in slices(texts, SET_SLICE):
                sets = [shingles(t, hashes, words) for t in texts[begin:end]]
                yield pa.RecordBatch.from_arrays([
                    batch.column("class").slice(begin, end - begin),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in signatures(sets, SKETCH_SYMBOLS)], pa.binary()),
                ], ["class", "members", "sketch"])

    def sets_of(rows: DataFrame) -> DataFrame:
        texts = wanted.select("doc_id", "text", F.xxhash64("text").alias("mark")).join(rows, ["doc_id", "mark"])
        return texts.select("class", "text").mapInArrow(run, "class bigint, members binary, sketch binary")

    named = prints.filter("doc_id IS NOT NULL").select("doc_id", "mark", F.col("row").alias("class"))
    again = repeats_of(named).withColumn("again", F.lit(True))
    chosen = named.join(keyed.select("class").distinct(), "class", "left_semi").join(again, ["doc_id", "mark"], "left")
    chosen = stage(chosen, "chosen")
    wanted, _ = split_by_filter(docs.select("doc_id", "text"), text_key(docs), key_filter(chosen.select("doc_id", "mark")))
    once, repeated = (chosen.filter(f).drop("again") for f in ("again IS NULL", "again"))
    return sets_of(once).union(sets_of(repeated).dropDuplicates(["class"]))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(c: str) -> DataFrame:
        return sets.select(F.col("class").alias(c), F.col("members").alias(f"set_{c}"))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(similar, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(class, label): the smallest class reachable, for every class that has a link.

    Each round takes the smallest label among the neighbours, then the label of that label; it ends
    when no label changes.  Reductions are partial before the shuffle, so hubs do not matter.
    """
    edges = stage(links.union(links.select("b", "a")).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("a").alias("class")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        offered = edges.join(labels.select(F.col("class").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("offer"))
        nearer = labels.join(offered, labels["class"] == offered["a"]).select(
            "class", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        jump = labels.select(F.col("class").alias("label"), F.col("label").alias("beyond"))
        new = stage(nearer.join(jump, "label").select("class", "old", F.least("label", "beyond").alias("label")), "labels")
        changed = new.filter("label < old").limit(1).count()
        labels = new.select("class", "label")
        if not changed:
            return labels


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(row, doc_id, mark, n_shingles, group, component_id) of each row of the documents.

    ``group`` is the same number for all rows of a component, and ``row`` numbers the rows.
    """
    limits = layout(percent)
    prints = stage(fingerprints(docs).withColumn("row", F.monotonically_increasing_id()), "prints")
    named = prints.filter("doc_id IS NOT NULL AND n_shingles > 0")
    by_print = named.groupBy("print1", "print2", "n_shingles").agg(
        F.min("row").alias("class"), F.min("doc_id").alias("lowest"), F.count("*").alias("rows"),
        F.first("signature").alias("signature"))
    # One row for each different set, under the first row that has it.
    classes = stage(by_print, "classes")
    keyed = stage(_shared_keys(classes, limits.chunks), "keys")
    sets = stage(candidate_sets(keyed, prints, docs), "sets")
    links = stage(confirm(screen(leader_pairs(keyed), classes, limits.least_equal), sets, percent), "links")
    for _ in range(ROUNDS):
        members = block_members(keyed, components(links)).join(classes.select("class", "signature"), "class")
        best = members.groupBy("key", "i", "j").applyInArrow(
            lambda rows: best_pairs(rows, limits), "a bigint, b bigint").distinct()
        links = links.union(stage(confirm(best, sets, percent), "links"))
    symbols = classes.select("class", "signature").join(sets.select("class", "sketch"), "class")
    members = block_members(keyed, components(links)).join(symbols, "class")
    rest = members.groupBy("key", "i", "j").applyInArrow(lambda rows: all_pairs(rows, limits), "a bigint, b bigint")
    links = links.union(stage(confirm(rest, sets, percent), "links"))
    labels = components(links)
    named_classes = classes.select("class", "print1", "print2", "n_shingles", "lowest", "rows").join(labels, "class", "left")
    least = named_classes.filter("label IS NOT NULL").groupBy("label").agg(F.min("lowest").alias("component"))
    ends = named_classes.filter("rows > 1 OR label IS NOT NULL").join(least, "label", "left").select(
        "print1", "print2", "n_shingles", F.coalesce("label", "class").alias("group"),
        F.coalesce("component", "lowest").alias("component"))
    joined = prints.drop("signature").join(ends, ["print1", "print2", "n_shingles"], "left")
    in_group = F.col("doc_id").isNotNull()
    return joined.select(
        "row", "doc_id", "mark", "n_shingles",
        F.when(in_group, F.coalesce("group", "row")).otherwise(F.col("row")).alias("group"),
        F.when(in_group, F.coalesce("component", "doc_id")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return grouped(docs, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _shared_keys(classes: DataFrame, chunks: int) -> DataFrame:
    """(key, slot, class) of the keys that several classes share; ``slot`` numbers a class's keys."""
    all_keys = classes.select("class", F.posexplode(chunk_keys(chunks=chunks)).alias("slot", "key"))
    shared = all_keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    return all_keys.join(shared, "key")


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, unchanged.

    Rows that repeat a doc_id and its text are one document.  Of a group's rows that have the smallest
    doc_id with different texts, one stays.  Rows with a null doc_id all stay.
    """
    rows = stage(grouped(docs, percent).filter("doc_id IS NOT NULL"), "groups")
    first = F.min(F.struct("row", "doc_id", "mark")).alias("first")
    stays = rows.filter("doc_id = component_id").groupBy("group").agg(first).select("first.doc_id", "first.mark").distinct()
    repeated = repeats_of(rows).withColumn("again", F.lit(True))
    others = rows.select("doc_id", "mark").distinct().join(stays, ["doc_id", "mark"], "left_anti")
    # What does not simply stay is the smaller part, so the documents are joined with that.
    gone = stage(others.union(repeated.select("doc_id", "mark")).distinct(), "gone")
    once_again = stage(stays.join(repeated, ["doc_id", "mark"], "left_semi"), "repeated")

    # What is gone or repeated is in the filter, so all other documents stay without a shuffle.
    perhaps, stay = split_by_filter(docs, text_key(docs), key_filter(gone))

    def same(side: DataFrame) -> Column:
        return (perhaps["doc_id"] == side["doc_id"]) & (F.xxhash64(perhaps["text"]) == side["mark"])

    kept = stay.union(perhaps.join(gone, same(gone), "left_anti"))
    return kept.union(perhaps.join(once_again, same(once_again), "left_semi").dropDuplicates(["doc_id", "text"]))


# All pairs that share a member, and the transitive closure of the links; for small tables.
NEAR_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), members AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - {WORDS - 2}, 2)),
                                                lambda i: array_to_string(w[i : i + {WORDS - 1}], ' '))) AS m
  FROM words WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM members GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM members x JOIN members y ON x.m = y.m AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id
  WHERE 100 * shared.n >= {PERCENT} * (s.n + t.n - shared.n)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
