"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A document counts its words (runs without ASCII blanks), at least 1.  With the share ``p`` of a
source in all words, its weight is ``p ** a`` over the sum of these.  The exponent ``a`` is bisected
in [0, 1]: 0 gives equal weights and most entropy, 1 the natural shares and fewest repeats.

``max_repeats``     the least exponent at which no source is repeated more often than this
``target_entropy``  the greatest exponent whose entropy is at least this share of the log of the
                    number of sources

A source's quota is its weight times the budget of words, at least 1, and a whole number of epochs
where it differs from one by rounding errors only.  Its documents are taken in epochs, each in a new
order by a hash of seed, epoch, doc_id and text, until the quota is used up: whole epochs, and from
the last one the documents that end within it.  A source whose first document does not fit gives that
one, so no source is lost; otherwise the budget is kept.  ``position`` is the words of the source
before a copy.  The sequence is cut into blocks of about ``block_tokens``; every source gives each
block its weight, and within a block copies are ordered by another hash, ``order_key``.

With ``keep_all`` the budget is what gives the least repeated source, the largest, one whole epoch:
every document is taken at least once and weights are reached by repeats alone.

Words before a copy are summed in two levels (buckets of the hash, then rows of a bucket), so no
window holds a whole source.  Only DataFrame functions are used.

``mixed_documents`` sums words without the texts and keeps where blocks begin: in each source and epoch
the copy, in the order of its hash, from which on another block follows.  These bounds, a few for each
block and source, are broadcast, so a text is shuffled once, to its block.  Equal rows that a bound
falls between are counted one by one.

A null source counts as the empty one.  Null and empty texts count 1.  Repeated rows are copies of
their own, in one bucket if doc_id and text are equal.  Further columns, whatever their names, ride
along in ``row``; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from andesite.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
BISECTIONS = 40
BLOCK_TOKENS = 1_000_000
# Rounding errors of a quota, as shares of the words of its source and of the budget.
TOLERANCE = 1e-9, 1e-11
HEX_DIGITS = 3  # leading digits of the hash that make a bucket
RANGE_DIGITS = 2  # and those that make a range of bounds
# Bounds that are broadcast; with more (very many sources), Spark chooses the join.
MOST_BOUNDS = 500_000


def size_of(text: str = "text") -> Column:
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD))
    return F.greatest(words, F.lit(1)).cast("bigint")


def source_shares(docs: DataFrame) -> DataFrame:
    """(source, tokens) of each source, written once."""
    source = F.coalesce(F.col("source"), F.lit("")).alias("source")
    return stage(docs.select(source, size_of().alias("size")).groupBy("source").agg(
        F.sum("size").alias("tokens")), "sources")


def find_exponent(
    sources: DataFrame, total: int, budget: int, max_repeats: float | None, target_entropy: float | None,
    keep_all: bool = False,
) -> float:
    """Bisect the exponent; each step is one aggregation over the sources."""
    p = F.col("tokens") / F.lit(total)
    count = sources.count()

    def meets(a: float) -> bool:
        power = F.pow(p, F.lit(a))
        repeats = F.pow(p, F.lit(a - 1))
        z, y, most, least = sources.agg(
            F.sum(power), F.sum(power * F.log(p)), F.max(repeats), F.min(repeats)
        ).first()
        if keep_all:
            return most / least <= max_repeats
        if max_repeats is not None:
            return most / z * budget / total <= max_repeats
        return math.log(z) - a * y / z < target_entropy * math.log(count)

    low, high = 0.0, 1.0
    if meets(low):
        return low
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (low, middle) if meets(middle) else (middle, high)
    return high if max_repeats is not None else low


def source_quotas(
    docs: DataFrame, budget_share: float, max_repeats: float | None, target_entropy: float | None,
    block_tokens: int, keep_all: bool,
) -> DataFrame:
    """(source, quota, epochs, rest, source_tokens, per_block) of each source."""
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give either max_repeats or target_entropy")
    if keep_all and (max_repeats is None or budget_share != 1.0):
        raise ValueError("keep_all needs max_repeats and sets the budget itself")
    sources = source_shares(docs)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = math.floor(total * budget_share)
    exponent = find_exponent(sources, total, budget, max_repeats, target_entropy, keep_all) if total else 1.0
    share = F.col("tokens") / F.lit(max(total, 1))
    power = F.pow(share, F.lit(exponent))
    z, least = sources.agg(F.sum(power), F.min(F.pow(share, F.lit(exponent - 1)))).first()
    z, least = z or 1.0, least or 1.0
    if keep_all:
        budget = math.ceil(total * z / least)
    blocks = max(1, -(-budget // block_tokens))
    # Rounding errors must not cost a source whose quota is whole epochs its last document.
    exact = power / F.lit(z) * F.lit(budget)
    whole = F.round(exact / F.col("tokens")) * F.col("tokens")
    noise = F.col("tokens") * F.lit(TOLERANCE[0]) + F.lit(budget * TOLERANCE[1])
    near = F.abs(exact - whole) <= noise
    quota = F.greatest(F.when(near, whole).otherwise(F.floor(exact)).cast("bigint"), F.lit(1))
    return sources.select("source", "tokens", quota.alias("quota")).select(
        "source",
        "quota",
        F.expr("quota DIV tokens").alias("epochs"),
        F.expr("quota % tokens").alias("rest"),
        F.col("tokens").alias("source_tokens"),
        F.ceil(F.col("quota") / F.lit(blocks)).cast("bigint").alias("per_block"),
    )


def all_copies(docs: DataFrame, quotas: DataFrame, seed: str, carry: Sequence[str] | None) -> DataFrame:
    """The copies of all epochs, with their sources' quotas, hash and bucket."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"),
        F.col("doc_id").alias("id"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        size_of().alias("tokens"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("content"),
    )
    last = F.col("epochs") - F.when(F.col("rest") > 0, 0).otherwise(1)
    return (
        rows.join(quotas, "source").filter(last >= 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), "epoch", "id", "content")))
        .withColumn("bucket", F.substring("key", 1, HEX_DIGITS))
    )


GROUP = ["source", "epoch", "bucket"]


def with_start(copies: DataFrame) -> DataFrame:
    """Copies with ``start``, the words of their source and epoch before them."""
    # Words by bucket: read from the copies again, without the rows that ride along.
    sums = copies.groupBy(*GROUP).agg(F.sum("tokens").alias("bucket_tokens"))
    earlier = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*GROUP, F.coalesce(F.sum("bucket_tokens").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*GROUP).orderBy("key", "id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return copies.join(before, GROUP).withColumn("start", start)


def with_block(started: DataFrame) -> DataFrame:
    """Copies with position and block; the block is null where a copy is not taken."""
    first = (F.col("epoch") == 0) & (F.col("start") == 0)
    taken = first | (F.col("epoch") < F.col("epochs")) | (F.col("start") + F.col("tokens") <= F.col("rest"))
    return (
        started.withColumn("position", F.col("epoch") * F.col("source_tokens") + F.col("start"))
        .withColumn("block", F.when(taken, F.expr("position DIV per_block")))
    )


def order_key(seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), "block", "epoch", "id", "content")).alias("order_key")


def mix(
    docs: DataFrame,
    budget_share: float = 1.0,
    max_repeats: float | None = 4.0,
    target_entropy: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = SEED,
    carry: Sequence[str] | None = None,
    keep_all: bool = False,
) -> DataFrame:
    """Copies of the documents to take: row, source, epoch, tokens, position, block, order_key.

    ``row`` has the columns to ``carry``, which are shuffled with each copy: all, unless named.
    ``budget_share`` is the budget as a share of all words there are; ``keep_all`` needs a limit on
    repeats and none on the budget.  A limit on repeats that no weights can meet gives the natural shares.
    """
    quotas = source_quotas(docs, budget_share, max_repeats, target_entropy, block_tokens, keep_all)
    return with_block(with_start(all_copies(docs, quotas, seed, carry))).filter("block IS NOT NULL").select(
        "row", "source", "epoch", "tokens", "position", "block", order_key(seed))


def block_bounds(copies: DataFrame) -> DataFrame:
    """(source, epoch, range, bounds): where another block begins, as arrays in the order of the copies.

    A bound has a key, the words before the first row with that key, the block from there on (null: not
    taken) and ``cut``, whether it falls between equal rows.  Each range begins with a bound of its own.
    """
    placed = with_block(with_start(stage(copies.drop("row", "id", "content").withColumn("id", F.lit(0)), "copies")))
    order = Window.partitionBy(*GROUP).orderBy("key", "start")
    same = F.lag("block").over(order).eqNullSafe(F.col("block")) & (F.row_number().over(order) > 1)
    changes = placed.withColumns({
        "same": same,
        "cut": F.coalesce(F.lag("key").over(order) == F.col("key"), F.lit(False)),
        "lowest": F.min("start").over(Window.partitionBy(*GROUP, "key")),
    }).filter("NOT same")
    changes = stage(changes.select("source", "epoch", "key", "start", "lowest", "block", "cut"), "changes")
    # The first copy of a bucket is no bound if its block goes on from the bucket before.
    order = Window.partitionBy("source", "epoch").orderBy("key", "start")
    range_ = F.substring("key", 1, RANGE_DIGITS)
    goes_on = (F.lag("block").over(order).eqNullSafe(F.col("block"))
               & (F.substring(F.lag("key").over(order), 1, RANGE_DIGITS) == range_))
    bounds = changes.withColumn("range", range_).withColumn("again", F.coalesce(goes_on, F.lit(False))).filter("NOT again")
    sorted_ = F.sort_array(F.collect_list(F.struct("key", "start", "lowest", "block", "cut")))
    return stage(bounds.groupBy("source", "epoch", "range").agg(sorted_.alias("bounds")), "bounds")


def mixed_documents(
    docs: DataFrame,
    budget_share: float = 1.0,
    max_repeats: float | None = 4.0,
    target_entropy: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = SEED,
    carry: Sequence[str] | None = None,
    keep_all: bool = False,
) -> DataFrame:
    """The copies that ``mix`` takes, with the columns of the documents, in the order of the permuted blocks.

    A partition holds slices of blocks, each a range of ``order_key``, so that no task has a whole block.
    """
    quotas = source_quotas(docs, budget_share, max_repeats, target_entropy, block_tokens, keep_all)
    copies = all_copies(docs, quotas, seed, carry)
    bounds = block_bounds(copies)
    n_bounds, n_cut = bounds.agg(
        F.coalesce(F.sum(F.size("bounds")), F.lit(0)),
        F.count_if(F.exists("bounds", lambda b: b["cut"]))).first()
    on = ["source", "epoch", "range"]
    at = F.element_at(F.filter("bounds", lambda b: b["key"] <= F.col("key")), -1)
    placed = copies.withColumn("range", F.substring("key", 1, RANGE_DIGITS)).join(
        F.broadcast(bounds) if n_bounds <= MOST_BOUNDS else bounds, on).withColumn("at", at).drop("bounds")
    kept = ["row", "epoch", "id", "content", "block"]
    if n_cut:
        cut = (F.col("at.key") == F.col("key")) & F.col("at.cut")
        number = F.row_number().over(Window.partitionBy("source", "epoch", "key").orderBy("id")) - 1
        start = F.col("at.lowest") + number * F.col("tokens")
        counted = with_block(placed.filter(cut).withColumn("start", start))
        blocks = placed.filter(~cut).withColumn("block", F.col("at.block")).select(*kept).union(counted.select(*kept))
    else:
        blocks = placed.withColumn("block", F.col("at.block")).select(*kept)
    mixed = blocks.filter("block IS NOT NULL").select("row", "block", order_key(seed))
    mixed = mixed.withColumn("slice", F.substring("order_key", 1, 2))
    return mixed.repartition("block", "slice").sortWithinPartitions("block", "order_key").select("row.*")


MIX_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(text, '')) AS content,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1) AS tokens
  FROM documents
), sources AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM sized GROUP BY source),
whole AS (SELECT sum(tokens)::BIGINT AS total, list(tokens) AS each FROM sources),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 0.0::DOUBLE AS tried
  UNION ALL
  SELECT step + 1,
         CASE WHEN step = 0 OR ok THEN low ELSE tried END,
         CASE WHEN step = 0 THEN (CASE WHEN ok THEN 0.0 ELSE high END) WHEN ok THEN tried ELSE high END,
         (CASE WHEN step = 0 OR ok THEN low ELSE tried END
          + CASE WHEN step = 0 THEN (CASE WHEN ok THEN 0.0 ELSE high END) WHEN ok THEN tried ELSE high END) / 2
  FROM (
    SELECT b.*, list_max(list_transform(each, lambda t: pow(t / total, tried - 1)))
           / list_sum(list_transform(each, lambda t: pow(t / total, tried))) <= 4 AS ok
    FROM bisect b, whole
  ) WHERE step <= {BISECTIONS}
), chosen AS (SELECT high AS a FROM bisect ORDER BY step DESC LIMIT 1),
powers AS (SELECT source, tokens AS source_tokens, total, pow(tokens / total, a) AS power FROM sources, whole, chosen),
exact AS (
  SELECT source, source_tokens, total, power / (SELECT sum(power) FROM powers) * total AS exact FROM powers
), quotas AS (
  SELECT source, source_tokens,
         greatest(1, CASE WHEN abs(exact - round(exact / source_tokens) * source_tokens)
                               <= source_tokens * {TOLERANCE[0]} + total * {TOLERANCE[1]}
                          THEN round(exact / source_tokens) * source_tokens ELSE floor(exact) END::BIGINT) AS quota,
         greatest(1, CAST(ceil(total / {BLOCK_TOKENS}) AS BIGINT)) AS blocks
  FROM exact
), copies AS (
  SELECT doc_id, source, content, tokens, source_tokens, quota % source_tokens AS rest, quota // source_tokens AS epochs,
         CAST(ceil(quota / blocks) AS BIGINT) AS per_block,
         unnest(range(quota // source_tokens + CASE WHEN quota % source_tokens > 0 THEN 1 ELSE 0 END)) AS epoch
  FROM sized JOIN quotas USING (source)
), ordered AS (
  SELECT *, coalesce(sum(tokens) OVER (
           PARTITION BY source, epoch ORDER BY md5(concat_ws(':', '{SEED}', epoch, doc_id, content)), doc_id, tokens
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM copies
)
SELECT doc_id, source, epoch, tokens, epoch * source_tokens + start AS position,
       (epoch * source_tokens + start) // per_block AS block,
       md5(concat_ws(':', '{SEED}', (epoch * source_tokens + start) // per_block, epoch, doc_id, content)) AS order_key
FROM ordered WHERE epoch < epochs OR start + tokens <= rest OR (epoch = 0 AND start = 0)
"""
