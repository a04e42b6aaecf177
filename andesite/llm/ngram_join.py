"""Jaccard join of documents by word n-grams: size-banded tiles with hashed bitmap signatures.

A document's set is its distinct runs of ``WORDS`` words (A-Z lower-cased, split at ASCII blanks); with
fewer words the whole sequence is the one member, without words the set is empty.  Documents link if
their sets have a Jaccard similarity of at least ``percent`` per cent.

1. A first pass over the texts counts runs in ``2 ** LEVEL_BITS`` buckets.  The logarithm of its bucket
   orders members, rare ones first.  Any order gives the same links; this one keeps common passages
   out of the keys.  What is broadcast is one byte per bucket, whatever the data.
2. A second pass writes each document's fingerprint, bitmap and keys: of n members the first
   ``n - ceil(percent * n) + 1`` in that order.  Two linked sets share one of these keys.
3. Equal sets become one class, so exact copies are never paired.  Classes that share a key meet in
   tiles of a key and two neighbouring size bands; linked sets lie in the same or in neighbouring bands,
   as a band's sizes grow by ``100 / percent``.
4. In a tile, pairs of fitting sizes are compared by their bitmaps.  A bit that one has and the other
   lacks is a member that the other lacks, so bit counts bound the overlap from above.  Wide bitmaps are
   folded to the narrower's width.  Each class names one partner that it may be similar to.
5. A third pass makes the sorted sets of the classes with a partner alone, chosen by ``FILTER_BITS`` bits
   of their hashed ids, so no text is ever shuffled.  The pairs are confirmed by exact intersection of
   the sorted sets, and links join components.  ``ROUNDS`` more rounds do the same for partners of another
   component.  This changes no result: it leaves fewer tiles for step 6.
6. In tiles that still hold several components, members of different components that pass by their bitmaps
   are chained, and each chain is sent once, with the sets of its members.  Within it all pairs of different
   components are compared, by bitmaps and then exactly, until a confirmed pair joins them.  What leaves a task
   is a row for each member of a chain and for each component joined; pairs do not.

Nothing is capped: a tile with more than ``BLOCK`` members is compared in pairs of blocks, each a group of
its own.  Where sets are sent, a block also has at most about ``BLOCK_SETS`` members of sets.

Null and empty texts have empty sets and are linked with nothing.  Rows that repeat a doc_id are one
document: what links to any of its texts is reachable through it.  Every row has a result, with the
size of its own set.  A null doc_id is linked with nothing and has a null component.  Further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from andesite.llm.common import WordHashes, byte_words, mix, slices, stage, window_hashes
from andesite.llm.near_dup import components, shingles

WORDS, PERCENT = 5, 80
LEVEL_BITS = 22
# Counts of buckets leave a task in ranges of this many.
RANGE = 1 << 16
# Widths of bitmaps in bits; a set of n members has the least power of two from 2 n on, within these.
NARROWEST, WIDEST = 256, 8192
# Bits of the filter that chooses documents for the third pass, and bits of a row of it.
FILTER_BITS, FILTER_ROW = 1 << 24, 1 << 15
BLOCK = 2048
# Members of all sets of a block, where sets are sent.
BLOCK_SETS = 1 << 21
ROUNDS = 1
# Pairs compared at once, and bytes of bitmaps on each side of them.
STRIP = 1 << 18
MAP_BYTES = 1 << 25

PRINT = ["n", "print1", "print2"]
KEYS = T.StructType([
    T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.LongType()) for c in PRINT],
    T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("bitmap", T.BinaryType()),
])
SETS = T.StructType([
    T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.LongType()) for c in PRINT],
    T.StructField("members", T.BinaryType()),
])


def bucket(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - LEVEL_BITS)


def runs_of(texts: list[str | None], hashes: WordHashes, words: int) -> np.ndarray:
    """The hashes of all runs of words in some texts; texts with fewer words are left out."""
    split = [w for w in (byte_words(t, lower=True) for t in texts) if len(w) >= words]
    if not split:
        return np.empty(0, np.uint64)
    sizes = np.array([len(w) for w in split])
    runs = window_hashes(hashes.of([w for own in split for w in own]), words)
    left = np.repeat(np.cumsum(sizes), sizes)[: len(runs)] - np.arange(len(runs))
    return runs[left >= words]


def member_levels(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """The logarithm of the number of runs in each bucket, over all documents.

    What a task counts in one bucket is sent as one byte, 255 standing for more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        counts = np.zeros(1 << LEVEL_BITS, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in slices(texts):
                runs = runs_of(texts[begin:end], hashes, words)
                counts += np.bincount(bucket(runs).astype(np.int64), minlength=len(counts))
        for at in range(0, len(counts), RANGE):
            part = counts[at : at + RANGE]
            if part.any():
                sent = np.minimum(part, 255).astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // RANGE], pa.int32()), pa.array([sent], pa.binary())], ["range", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(RANGE, np.int64)
        for counts in rows.column("counts"):
            total += np.frombuffer(counts.as_py(), np.uint8)
        level = np.frexp(total.astype(np.float64))[1].astype(np.uint8)
        return pa.table({"range": rows.column("range")[:1], "levels": pa.array([level.tobytes()], pa.binary())})

    partial = docs.select("text").mapInArrow(run, "range int, counts binary")
    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    for row in partial.groupBy("range").applyInArrow(add, "range int, levels binary").collect():
        levels[row["range"] * RANGE : (row["range"] + 1) * RANGE] = np.frombuffer(row["levels"], np.uint8)
    return levels


def n_keys(n: int, percent: int) -> int:
    """How many of n members are keys: of two sets that share none, more than that many differ."""
    return n - -(-percent * n // 100) + 1


def bitmap(members: np.ndarray) -> bytes:
    """A bit for each member, at its hash modulo the width."""
    width = min(max(NARROWEST, 1 << (2 * len(members) - 1).bit_length()), WIDEST)
    bits = np.zeros(width, np.uint8)
    bits[(members >> np.uint64(16)) & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(row: bytes, width: int) -> np.ndarray:
    """A bitmap as 64-bit words, ``width`` bytes of them; halves of a wider one are laid together."""
    words = np.frombuffer(row, np.uint64)
    while len(words) > width // 8:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words


def prints_of(sets: list[np.ndarray]) -> list[list]:
    """Sizes and fingerprints of sets; the latter null for empty sets."""
    rows = [
        (len(s), int(s.sum().view(np.int64)), int(mix(s ^ np.uint64(len(s))).sum().view(np.int64)))
        if len(s) else (0, None, None) for s in sets
    ]
    return [pa.array(column, pa.int64()) for column in zip(*rows)]


def keys_of(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """Size, fingerprint, keys and bitmap of each document's set."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, order = WordHashes(), shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                sets = [shingles(t, hashes, words) for t in part.column("text").to_pylist()]
                keys = []
                for s in sets:
                    first = np.lexsort((s, order[bucket(s)]))[: n_keys(len(s), percent)] if len(s) else []
                    keys.append(s[first].view(np.int64) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), *prints_of(sets), pa.array(keys, pa.list_(pa.int64())),
                     pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())], KEYS.names)

    return docs.select("doc_id", "text").mapInArrow(run, KEYS)


def filter_place() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit for each of the ids, at its hash; its size is fixed, whatever the number of ids."""
    place = ids.select(filter_place().alias("place"))
    rows = place.groupBy(F.expr(f"place div {FILTER_ROW}").alias("row")).agg(
        F.bitmap_construct_agg(F.col("place") % FILTER_ROW).alias("bits")).collect()
    bits = np.zeros((FILTER_BITS // FILTER_ROW, FILTER_ROW // 8), np.uint8)
    for r in rows:
        bits[r["row"]] = np.frombuffer(r["bits"], np.uint8)
    return bits.reshape(-1)


def sets_of(docs: DataFrame, wanted: np.ndarray, words: int = WORDS) -> DataFrame:
    """Sorted set of the documents that the filter lets pass, a few others among them."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), shared.value
        for batch in batches:
            place = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((bits[place >> 3] >> (place & 7) & 1).astype(bool)))
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                sets = [shingles(t, hashes, words) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.int64()), *prints_of(sets),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ], SETS.names)

    return docs.select("doc_id", "text", filter_place().alias("place")).mapInArrow(run, SETS)


def band(n: str, percent: int) -> Column:
    """The size band of a set: sizes of linked sets are at most one band apart."""
    return F.floor(F.log(F.col(n)) / math.log(100 / percent) if percent < 100 else F.col(n)).cast("int")


def fit(n: np.ndarray, m: np.ndarray, overlap: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap is enough for sets of these sizes."""
    return (100 + percent) * overlap >= percent * (n + m)


def overlap_bound(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The most members that sets of sizes n and m with these bitmaps can share."""
    left = np.bitwise_count(x & ~y).sum(-1, dtype=np.int64)
    right = np.bitwise_count(y & ~x).sum(-1, dtype=np.int64)
    return np.minimum(n - left, m - right)


def passing(n: np.ndarray, maps: list[bytes], x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows x and y may be similar by their bitmaps."""
    widths = np.fromiter(map(len, maps), np.int64, len(maps))
    narrow = np.minimum(widths[x], widths[y])
    out = np.zeros(len(x), bool)
    for width in np.unique(narrow).tolist():
        same = np.flatnonzero(narrow == width)
        at_once = max(1, MAP_BYTES // width)
        for begin in range(0, len(same), at_once):
            pairs = same[begin : begin + at_once]
            rows, place = np.unique(np.concatenate([x[pairs], y[pairs]]), return_inverse=True)
            folded = np.stack([fold(maps[r], width) for r in rows])
            left, right = folded[place[: len(pairs)]], folded[place[len(pairs) :]]
            most = overlap_bound(left, n[x[pairs]], right, n[y[pairs]])
            out[pairs] = fit(n[x[pairs]], n[y[pairs]], most, percent)
    return out


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sorted sets share enough members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = sorted((np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)), key=len)
                places = np.minimum(np.searchsorted(y, x), len(y) - 1)
                keep.append(bool(fit(len(x), len(y), int((y[places] == x).sum()), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(c: str) -> DataFrame:
        return sets.select(F.col("class").alias(c), F.col("members").alias(f"set_{c}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint").distinct()


def labelled(keyed: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their components."""
    return keyed.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))


def tile_members(members: DataFrame, blocks: Column | None = None) -> DataFrame:
    """Members of the tiles that hold several components, once for each pair of blocks they are in.

    A tile is a key and a band; members of the band are its upper ones, those of the band below its lower.
    ``blocks`` is the number of blocks of a tile, as an aggregate.
    """
    blocks = F.ceil(F.count("*") / BLOCK) if blocks is None else blocks
    upper = members.withColumns({"tile": F.col("band"), "upper": F.lit(True)})
    lower = members.withColumns({"tile": F.col("band") + 1, "upper": F.lit(False)})
    placed = upper.unionByName(lower)
    tiles = placed.groupBy("key", "tile").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), blocks.alias("blocks"),
        F.count_if("upper").alias("uppers"), F.min("class").alias("lead"))
    mixed = tiles.filter("least < most AND uppers > 0").select("key", "tile", "lead", "blocks")
    # A member of block i is in the groups (i, j) and (j, i) of its tile.
    return (
        placed.join(mixed, ["key", "tile"]).withColumn("own", F.pmod(F.xxhash64("class"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select("lead", "key", "tile", "class", "label", "upper", "own",
                F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )


# Tiles with the same smallest class have much the same members, so they are handled by one task.
PLACE = ["lead", "i", "j"]
TILE = [*PLACE, "key", "tile"]


class Tiles:
    """Members of some tiles, those of a tile one after the other.

    Pairs of the same label or of the same chain are left out; both may be joined while pairs are read.
    """

    def __init__(self, rows: pa.Table):
        self.rows = rows
        column = lambda c: rows.column(c).to_numpy()
        self.ids, self.labels, self.own, self.n = map(column, ("class", "label", "own", "n"))
        self.chains = self.ids
        self.upper = column("upper").astype(bool)
        keys = [column(c) for c in TILE]
        starts = np.ones(len(self.ids), bool)
        starts[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        self.starts = np.flatnonzero(starts)
        self.within = keys[1] == keys[2]
        self.place = np.stack(keys[:3])

    @cached_property
    def sets(self) -> list[np.ndarray]:
        return [np.frombuffer(s.as_buffer(), np.uint64) for s in self.rows.column("members")]

    @cached_property
    def maps(self) -> list[bytes]:
        if "bitmap" in self.rows.column_names:
            return self.rows.column("bitmap").to_pylist()
        return [bitmap(s) for s in self.sets]

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows x < y of a tile that may be similar, in strips."""
        ends = np.append(self.starts[1:], len(self.ids))
        behind = np.repeat(ends, ends - self.starts) - np.arange(len(self.ids)) - 1
        upto = np.cumsum(behind)
        begin = 0
        while begin < len(behind):
            before = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, before + STRIP, "right")))
            x = np.repeat(np.arange(begin, end), behind[begin:end])
            y = x + 1 + np.arange(len(x)) - (np.repeat(upto[begin:end] - behind[begin:end], behind[begin:end]) - before)
            begin = end
            small, large = np.minimum(self.n[x], self.n[y]), np.maximum(self.n[x], self.n[y])
            keep = ((self.labels[x] != self.labels[y]) & (self.chains[x] != self.chains[y]) & (self.upper[x] | self.upper[y])
                    & (self.within[x] | (self.own[x] != self.own[y])) & (100 * small >= percent * large))
            x, y = x[keep], y[keep]
            if len(x):
                keep = passing(self.n, self.maps, x, y, percent)
                yield x[keep], y[keep]


def partners(members: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may be similar: one for each member that has a partner of another component."""

    def smallest(tiles: Tiles) -> np.ndarray:
        """Place, member and smallest partner, once for each member of a place."""
        found = [np.empty((5, 0), np.int64)]
        for x, y in tiles.pairs(percent):
            both, other = np.concatenate([x, y]), np.concatenate([y, x])
            found.append(_first_of(np.vstack([tiles.place[:, both], tiles.ids[both], tiles.ids[other]])))
        return _first_of(np.concatenate(found, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = np.empty((4, 0), np.int64)  # members of the last place that have been named already
        for tiles in whole_tiles(batches):
            rows = smallest(tiles)
            named = named[:, (named[:3] == tiles.place[:, :1]).all(0)]
            rows = rows[:, ~np.isin(rows[3], named[3]) | (rows[:3] != tiles.place[:, :1]).any(0)]
            last = rows[:4, (rows[:3] == tiles.place[:, -1:]).all(0)]
            same = (tiles.place[:, 0] == tiles.place[:, -1]).all()
            named = np.concatenate([named, last], axis=1) if same else last
            yield pa.RecordBatch.from_arrays([pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())], ["class", "partner"])

    named = placed_tiles(members, maps).mapInArrow(run, "class bigint, partner bigint")
    one = named.groupBy("class").agg(F.min("partner").alias("partner"))
    return one.select(F.least("class", "partner").alias("a"), F.greatest("class", "partner").alias("b")).distinct()


def _first_of(rows: np.ndarray) -> np.ndarray:
    """Columns of which all rows but the last differ, with the smallest last row."""
    rows = rows[:, np.lexsort(rows[::-1])]
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[:-1, 1:] != rows[:-1, :-1]).any(0)
    return rows[:, first]


def whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[Tiles]:
    """The tiles of sorted rows; one that goes on in the next batch is held back."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, rows]) if held else rows
        last = Tiles(held).starts[-1] if held.num_rows else 0
        if last:
            yield Tiles(held.slice(0, last))
            held = held.slice(last)
    if held and held.num_rows:
        yield Tiles(held)


def placed_tiles(members: DataFrame, data: DataFrame, blocks: Column | None = None) -> DataFrame:
    """Rows of tiles with what ``data`` has of their classes."""
    rows = tile_members(members, blocks).join(data, "class")
    return rows.repartition(*PLACE).sortWithinPartitions(*TILE)


def joined_labels(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after those of rows x and y have been joined: the smallest of all that hang together."""
    names, codes = np.unique(labels, return_inverse=True)
    root = np.arange(len(names))
    a, b = codes[x], codes[y]
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return names[root[codes]]
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def chains(members: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """(key, class): chains of members of different components that may be similar, each under a hash of all its members.

    Two members that may be similar are in a chain of the same key at least once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tiles in whole_tiles(batches):
            for x, y in tiles.pairs(percent):
                tiles.chains = joined_labels(tiles.chains, x, y)
            ids, rows = np.unique(tiles.ids, return_index=True)
            _, chain, size = np.unique(tiles.chains[rows], return_inverse=True, return_counts=True)
            names = np.zeros(len(size), np.uint64)
            np.add.at(names, chain, mix(ids.view(np.uint64)))
            chained = size[chain] > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)[chain][chained]), pa.array(ids[chained])], ["key", "class"])

    return placed_tiles(members, maps).mapInArrow(run, "key bigint, class bigint").distinct()


def similar(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of other sorted sets share enough members with one."""
    sizes = np.array([len(s) for s in others])
    every = np.concatenate(others)
    places = np.minimum(np.searchsorted(own, every), len(own) - 1)
    shared = np.add.reduceat((own[places] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return fit(len(own), sizes, shared, percent)


def joins(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): labels of components that a pair of similar sets joins, at most one row for each label of a tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tiles in whole_tiles(batches):
            before, labels = tiles.labels, tiles.labels.copy()
            tiles.labels = labels
            for x, y in tiles.pairs(percent):
                rows, starts = np.unique(x, return_index=True)
                for row, others in zip(rows, np.split(y, starts[1:])):
                    others = others[labels[others] != labels[row]]
                    if len(others):
                        others = others[similar(tiles.sets[row], [tiles.sets[o] for o in others], percent)]
                        one = np.unique(labels[np.append(others, row)])
                        if len(one) > 1:
                            labels[np.isin(labels, one)] = one[0]
            changed = before != labels
            a, b = np.unique(np.stack([labels[changed], before[changed]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SETS))
    return placed_tiles(members, sets, blocks).mapInArrow(run, "a bigint, b bigint").distinct()


def classes_of(prints: DataFrame) -> DataFrame:
    """(class, least, print): one row for each different set, and the smallest doc_id that has it."""
    named = prints.filter("doc_id IS NOT NULL AND n > 0")
    # Written by the caller, which fixes the numbers.
    return named.groupBy(*PRINT).agg(F.min("doc_id").alias("least")).withColumn("class", F.monotonically_increasing_id())


def shared_keys(keyed: DataFrame) -> DataFrame:
    """The rows of keys that are there more than once."""
    several = keyed.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    return keyed.join(several.select("key"), "key")


def ngram_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document."""
    if not 0 < percent <= 100:
        raise ValueError("the similarity must be above 0 and at most 100 per cent")
    prints = stage(keys_of(docs, member_levels(docs, words), percent, words), "prints")
    classes = stage(classes_of(prints), "classes")
    # A class is read where its smallest doc_id is; a repeated row only repeats its rows.
    rep = classes.withColumnRenamed("least", "doc_id")
    on = ["doc_id", *PRINT]
    keyed = prints.join(rep, on).select(F.explode("keys").alias("key"), "class", band("n", percent).alias("band"))
    keyed = stage(shared_keys(keyed), "keys")
    maps = stage(prints.select(*on, "bitmap").join(rep, on).select("class", "n", "bitmap"), "maps")
    alone = keyed.withColumn("label", F.col("class"))
    first = stage(partners(alone, maps, percent), "pairs")
    paired = first.select(F.col("a").alias("class")).union(first.select("b")).distinct()
    wanted = stage(rep.join(paired, "class", "left_semi"), "wanted")
    full = stage(sets_of(docs, id_filter(wanted), words).join(wanted, on).select("class", "n", "members"), "sets")

    # A document with several texts joins their classes.
    texts = prints.filter("doc_id IS NOT NULL AND n > 0").select(*on).join(classes.drop("least"), PRINT)
    several = texts.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b"))
    links = stage(
        texts.join(several.filter("a < b"), "doc_id").filter("class > a").select("a", F.col("class").alias("b")).distinct(),
        "links")
    links = links.union(stage(confirmed(first, full, percent), "links"))
    plausible = keyed.join(wanted.select("class"), "class", "left_semi")
    for _ in range(ROUNDS):
        more = partners(labelled(plausible, components(links)), maps, percent)
        links = links.union(stage(confirmed(more, full, percent), "links"))
    labels = components(links)
    chained = stage(chains(labelled(plausible, labels), maps, percent), "chains")
    sized = chained.join(wanted.select("class", "n", band("n", percent).alias("band")), "class")
    links = links.union(stage(joins(labelled(sized, labels), full, percent), "links"))

    named = labelled(classes, components(links))
    lowest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    joined = named.join(lowest, "label").select(*PRINT, "component_id")
    result = prints.select(*on).join(joined, PRINT, "left")
    return result.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


# All pairs that share a member, and the transitive closure of the links; for small tables.
JOIN_SQL = f"""
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
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
