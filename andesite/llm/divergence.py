"""Source divergence audit: how far the sources of a language differ in their words.

Terms are runs of letters A-Z (lower-cased) and of all characters beyond ASCII.  A language keeps the
terms that at least ``LEAST_DOCS`` of its documents hold, V of them.  A group (language, source) or a whole
language gives each kept term the price ``1 + floor(10^9 * (count + 5) / (N + 5 * V))``, N being the sum of
its counts.  Part ``pair`` adds up, for each two sources of a language, the differences of their prices
over all kept terms; part ``term`` names the terms that a source uses more than its language.

1. Tasks count occurrences and documents of the terms of each group, and pass their counts on
   whenever they hold ``HELD`` terms; the sums are written once.
2. Kept terms get an id and a block of their language, at most about ``BLOCK`` terms each, so no task holds
   a whole vocabulary.  Every group has a sorted array of (id, count) per block.
3. Sources lie in bundles of about ``BUNDLE``.  One task takes the co-grouped arrays of two bundles and one
   block, and prices each unordered pair once: a galloping search of the shorter array in the longer
   finds the common terms; terms of one side and absent ones are priced against the other's price of
   a count of zero.  The sum serves both directions.
4. Blocks are added up and ranked.

All arithmetic is on whole numbers; counts may reach 9 * 10^15.  A term's rows are one per source, so hot
sources, terms and documents are reduced to counts before any shuffle.

Null text, language and source are ''.  Empty texts have no terms, but their group has all its pairs.
A language without kept terms has pairs of value 0.  Repeated rows are documents of their own, doc_id
and further columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from andesite.llm.common import stage

LEAST_DOCS = 30
TOP_TERMS = 50
# Terms that a task holds before it passes its counts on; terms of a block; sources of a bundle.
HELD, BLOCK, BUNDLE = 500_000, 65_536, 16
# Bytes that are part of no term become blanks, A-Z become a-z; all others are beyond ASCII.
TO_TERMS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
# Longer texts are cut between terms, to bound the lists made of them.
CUT = 1 << 20

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
PRICED = "lang string, source string, item string, value bigint"
KEYS = ["lang", "source"]


def text_pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    raw = raw.translate(TO_TERMS)
    start = 0
    while len(raw) - start > CUT:
        end = raw.find(b" ", start + CUT)
        if end < 0:
            break
        yield raw[start:end].split()
        start = end
    yield raw[start:].split()


class Held:
    """Occurrences and documents of each group's terms, in one task."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, lang: str, source: str, raw: bytes) -> None:
        seen, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(docs)
        own: set[bytes] = set()
        for terms in text_pieces(raw):
            seen.update(terms)
            own.update(terms)
        docs.update(own)
        self.size += len(docs) - before

    def flush(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (seen, docs) in self.groups.items():
            terms = list(docs)
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([seen[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64()),
                ], ["lang", "source", "term", "n", "docs"])
        self.groups.clear()
        self.size = 0


def named(docs: DataFrame) -> DataFrame:
    """Language, source and text, nulls being ''."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*KEYS, "text")])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                held.add(lang, source, text.as_py())
                if held.size >= HELD:
                    yield from held.flush()
        yield from held.flush()

    partial = named(docs).mapInArrow(run, COUNTS)
    return partial.groupBy(*KEYS, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def prices(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """Prices of counts, exact by long division in steps of 1000."""
    if terms == 0:
        return np.ones(len(counts), np.int64)
    whole = total + 5 * terms
    rest = counts.astype(np.int64) + 5
    price = np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        price = price * 1000 + rest // whole
        rest %= whole
    return price + 1


def price_sql(count: str, total: str, terms: str) -> str:
    """The same in SQL on whole numbers."""
    whole, rest, price = f"({total} + 5 * {terms})", f"({count} + 5)", "0"
    for _ in range(3):
        rest = f"(({rest}) * 1000)"
        price = f"({price} * 1000 + {rest} div {whole})"
        rest = f"({rest} % {whole})"
    return f"(1 + {price})"


def gallop(small: np.ndarray, large: np.ndarray, run: int = 256) -> np.ndarray:
    """Where the members of one sorted array stand in another, -1 for those it lacks.

    Runs of members are looked up between where the run before ended and a bound that doubles until
    it passes the run's last member.
    """
    at = np.full(len(small), -1, np.int64)
    low = 0
    for begin in range(0, len(small), run):
        part = small[begin : begin + run]
        step = run
        while low + step < len(large) and large[low + step] < part[-1]:
            step *= 2
        window = large[low : low + step + 1]
        if not len(window):
            break
        places = np.searchsorted(window, part)
        found = np.flatnonzero(window[np.minimum(places, len(window) - 1)] == part)
        at[begin + found] = low + places[found]
        low += int(places[-1])
    return at


class Prices:
    """A group's kept terms of one block, with their prices."""

    def __init__(self, row: dict):
        self.lang, self.source, self.terms = row["lang"], row["source"], row["block_terms"]
        self.ids = np.array(row["ids"], np.int64)
        self.prices = prices(np.array(row["counts"], np.int64), row["total"], row["terms"])
        self.absent = int(prices(np.zeros(1, np.int64), row["total"], row["terms"])[0])

    def apart(self, other: Prices) -> int:
        """The sum of the differences over all kept terms of the block."""
        small, large = (self, other) if len(self.ids) <= len(other.ids) else (other, self)
        at = gallop(small.ids, large.ids)
        both = at >= 0
        matched = at[both]
        common = int(np.abs(small.prices[both] - large.prices[matched]).sum())
        only_small = int(np.abs(small.prices[~both] - large.absent).sum())
        against = np.abs(large.prices - small.absent)
        only_large = int(against.sum() - against[matched].sum())
        neither = small.terms - len(small.ids) - len(large.ids) + len(matched)
        return common + only_small + only_large + neither * abs(small.absent - large.absent)


def _price_bundles(left: pa.Table, right: pa.Table) -> pa.Table:
    """Both directions of every pair of a source of the left and one of the right bundle."""
    same = left.num_rows and right.num_rows and left.column("i")[0] == left.column("j")[0]
    ours, theirs = [Prices(r) for r in left.to_pylist()], [Prices(r) for r in right.to_pylist()]
    out: list[tuple] = []
    for a in ours:
        for b in theirs:
            if a.source < b.source or (not same and a.source != b.source):
                value = a.apart(b)
                out += [(a.lang, a.source, b.source, value), (a.lang, b.source, a.source, value)]
    columns = list(zip(*out)) or [()] * 4
    types = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("lang", "source", "item", "value"), columns, types)})


def pair_values(arrays: DataFrame, sources: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, from their arrays per block."""
    bundles = sources.groupBy("lang").agg(F.ceil(F.count("*") / BUNDLE).alias("bundles"))
    own = F.pmod(F.xxhash64("source"), "bundles")
    placed = arrays.join(bundles, "lang").withColumn("own", own)
    first = placed.withColumns({"i": F.col("own"), "j": F.explode(F.sequence("own", F.col("bundles") - 1))})
    second = placed.toDF(*placed.columns).withColumns({"j": F.col("own"), "i": F.explode(F.sequence(F.lit(0).cast("bigint"), "own"))})
    tile = ["lang", "block", "i", "j"]
    priced = first.groupBy(*tile).cogroup(second.groupBy(*tile)).applyInArrow(_price_bundles, PRICED)
    return priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): distances between sources, and terms a source prefers."""
    counts = stage(term_counts(docs), "terms")
    sources = stage(named(docs).select(*KEYS).distinct(), "sources")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stage(kept.filter(F.col("docs") >= least_docs).select("lang", "term", "lang_n"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    langs = sources.select("lang").distinct().join(langs, "lang", "left").select(
        "lang", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.greatest(F.ceil(F.col("terms") / BLOCK), F.lit(1)).alias("blocks"))
    langs = stage(langs, "langs")
    block = F.pmod(F.xxhash64("term"), "blocks")
    # Ids are fixed by writing them: another attempt of a task may number its rows differently.
    vocabulary = stage(kept.join(langs, "lang").withColumns(
        {"block": block, "id": F.monotonically_increasing_id()}).drop("blocks"), "vocabulary")
    used = stage(counts.drop("docs").join(vocabulary, ["lang", "term"]), "used")

    totals = used.groupBy(*KEYS).agg(F.sum("n").alias("total"))
    groups = sources.join(langs, "lang").join(totals, KEYS, "left").select(
        *KEYS, "terms", "blocks", F.coalesce("total", F.lit(0)).alias("total"))
    groups = stage(groups, "groups")
    entries = F.array_sort(F.collect_list(F.struct("id", "n")))
    sorted_arrays = used.groupBy(*KEYS, "block").agg(entries.alias("entries"))
    block_terms = vocabulary.groupBy("lang", "block").agg(F.count("*").alias("block_terms"))
    slots = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    arrays = slots.join(block_terms, ["lang", "block"], "left").join(sorted_arrays, [*KEYS, "block"], "left").select(
        *KEYS, "block", "terms", "total", F.coalesce("block_terms", F.lit(0)).alias("block_terms"),
        F.coalesce("entries.id", F.array().cast("array<bigint>")).alias("ids"),
        F.coalesce("entries.n", F.array().cast("array<bigint>")).alias("counts"))
    pairs = pair_values(stage(arrays, "arrays"), sources)

    own_price = F.expr(price_sql("n", "total", "terms"))
    lang_price = F.expr(price_sql("lang_n", "lang_total", "terms"))
    terms = used.join(groups.select(*KEYS, "total"), KEYS).filter("n > 0").select(
        *KEYS, F.col("term").alias("item"), (own_price - lang_price).alias("value")).filter("value > 0")

    order = Window.partitionBy(*KEYS).orderBy(F.col("value").desc(), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select(*KEYS, F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").union(ranked(terms, "term").filter(F.col("rank") <= top_terms))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIVERGENCE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
  FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL
), k AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {LEAST_DOCS}
), l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM g JOIN k ON g.lang = k.lang
       LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), t AS (SELECT lang, source, sum(n) AS total FROM f GROUP BY ALL),
p AS (
  SELECT f.lang, f.source, f.term, f.n, 1 + (1000000000 * (CAST(f.n AS HUGEINT) + 5)) // (t.total + 5 * l.v) AS p,
         1 + (1000000000 * (CAST(f.lang_n AS HUGEINT) + 5)) // (l.total + 5 * l.v) AS q
  FROM f JOIN t ON f.lang = t.lang AND f.source = t.source JOIN l ON f.lang = l.lang
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INTEGER) AS rank
  FROM p WHERE n > 0 AND p > q
) WHERE rank <= {TOP_TERMS}
"""
