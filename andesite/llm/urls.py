"""URL filter: host and path rules, and for other URLs a ratio of two character models.

Rules name a host and the start of a path; they fit the host and its subdomains, and the longest
rule that fits decides.  URLs that a rule decides train two smoothed character models of variable
order, one of allowed and one of blocked URLs: a character follows its two predecessors with a
probability that is interpolated with the one after its last predecessor, that with the one without
context, and that with the same for all characters.  The log of the ratio, for each of the ``SIZE``
cubed triples of characters, is one number; their mean over a URL's characters is its score.
Three sixteenths of the decided URLs are held out, and the bound between the mean scores of its two classes,
in the ratio of their deviations, tells allowed from blocked among the rest.

Letters are lower-cased and characters outside ``ALPHABET`` count as one, so the model has a fixed
size and reaches the URLs as a scalar subquery.  Only DataFrame functions are used.

Null and empty URLs, and URLs without ``://``, have empty host and path, fit no rule and are
blocked only if the score of nothing, 0, is below the bound.  If one class has no URLs, all others
are allowed.  Repeated rows are judged each; further columns are ignored; an empty table gives
no rows.  Ties with the bound are allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#[]@!$&'()*+,;=%"
SIZE = 64  # codes: 0 for other characters, 1 to 60 for the alphabet, START before the first
START = 63
WEIGHT = 5.0  # how many observations the shorter context is worth
HELD_OUT = "3"  # URLs whose hash begins with a smaller hexadecimal digit are held out
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Host, path, and the longest fitting rule with its verdict (null if none fits)."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [
        ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        for _, h, p in longest
    ]

    def first(values: list[str]) -> Column:
        pairs = list(zip(fits, values))
        return reduce(lambda chain, x: chain.when(*map(_lit, x)), pairs[1:], F.when(*map(_lit, pairs[0])))

    return parts.withColumns({
        "rule": first([h + p for _, h, p in longest]), "decided": first([v for v, _, _ in longest]),
    })


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def triples(url: Column) -> Column:
    """Codes of each character of a URL with its two predecessors."""
    one = F.transform(F.split(F.lower(url), ""), lambda c: F.instr(F.lit(ALPHABET), c))
    codes = F.when(F.length(url) > 0, one).otherwise(F.array().cast("array<int>"))
    padded = F.concat(F.array(F.lit(START), F.lit(START)), codes)
    return F.transform(
        codes,
        lambda c, i: F.get(padded, i) * (SIZE * SIZE) + F.get(padded, i + 1) * SIZE + c,
    )


def log_ratios(decided: DataFrame) -> DataFrame:
    """(code, ratio): for every triple the log of its probability in allowed over blocked URLs."""
    spark = decided.sparkSession
    seen = (
        decided.select("decided", F.explode(triples(F.col("url"))).alias("code"))
        .groupBy("code")
        .agg(*[F.count(F.when(F.col("decided") == v, 1)).alias(v) for v in ("allow", "block")])
    )
    # From here on every frame has a fixed number of rows: SIZE, its square or its cube.
    grid = spark.range(SIZE**3).select(F.col("id").cast("int").alias("code"))
    grid = grid.join(seen, "code", "left").fillna(0, ["allow", "block"]).withColumns({
        "last": F.col("code") % SIZE, "pair": F.col("code") % (SIZE * SIZE),
    })
    sums = [F.sum(v).alias(v) for v in ("allow", "block")]
    pairs = grid.groupBy("pair").agg(*sums)
    ones = pairs.groupBy((F.col("pair") % SIZE).alias("last")).agg(*sums)
    wholes = ones.agg(*sums)

    def total(df: DataFrame, key: Column) -> DataFrame:
        return df.groupBy(key.alias("context")).agg(*[F.sum(v).alias(f"all_{v}") for v in ("allow", "block")])

    def smooth(v: str, below: Column) -> Column:
        return (F.col(v) + WEIGHT * below) / (F.col(f"all_{v}") + WEIGHT)

    classes = ("allow", "block")
    order0 = ones.select("last", *[
        ((F.col(v) + WEIGHT / SIZE) / (wholes.select(v).scalar() + WEIGHT)).alias(f"p0_{v}") for v in classes
    ])
    context1 = (F.col("pair") / SIZE).cast("int")
    order1 = (
        pairs.withColumn("context", context1).join(total(pairs, context1), "context")
        .withColumn("last", F.col("pair") % SIZE).join(order0, "last")
        .select("pair", *[smooth(v, F.col(f"p0_{v}")).alias(f"p1_{v}") for v in classes])
    )
    context2 = (F.col("code") / SIZE).cast("int")
    order2 = grid.withColumn("context", context2).join(total(grid, context2), "context").join(order1, "pair")
    p = {v: smooth(v, F.col(f"p1_{v}")) for v in classes}
    return order2.select("code", (F.log(p["allow"]) - F.log(p["block"])).alias("ratio"))


def with_score(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """Mean log ratio over the characters of each URL, to nine decimals; 0 for an empty one.

    Each distinct URL is scored once.  The ratios are one array of ``SIZE`` cubed numbers.
    """
    rows = ratios.agg(F.sort_array(F.collect_list(F.struct("code", "ratio"))).alias("rows"))
    table = rows.select(F.col("rows.ratio")).scalar()
    codes = urls.select("url").distinct().select("url", F.explode(triples(F.col("url"))).alias("code"))
    scores = codes.groupBy("url").agg(F.round(F.avg(F.get(table, F.col("code"))), 9).alias("score"))
    return urls.join(scores, "url", "left").fillna(0.0, ["score"])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of each page."""
    ruled = with_rule(pages, rules)
    held = F.md5("url") < HELD_OUT
    ratios = log_ratios(ruled.filter(F.col("decided").isNotNull() & ~held))
    scored = with_score(ruled, ratios)
    sample = scored.filter(F.col("decided").isNotNull() & held)
    spread = [
        f(F.when(F.col("decided") == v, F.col("score"))).alias(f"{name}_{v}")
        for v in ("allow", "block") for name, f in (("mean", F.avg), ("dev", F.stddev_pop))
    ]
    devs = F.col("dev_allow") + F.col("dev_block")
    middle = F.when(devs == 0, (F.col("mean_allow") + F.col("mean_block")) / 2).otherwise(
        (F.col("mean_allow") * F.col("dev_block") + F.col("mean_block") * F.col("dev_allow")) / devs
    )
    bound = sample.agg(*spread).select(F.round(middle, 9)).scalar()
    by_score = F.when(F.col("score") < bound, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("decided", by_score).alias("verdict"), "score"
    )


def _in_classes(text: str) -> str:
    return ", ".join(text.replace("@", v) for v in ("allow", "block"))


_LETTER = "'" + ALPHABET.replace("'", "''") + "'"
_FITS = [
    (v, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')")
    for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
]
URLS_SQL = f"""
WITH rests AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), ruled AS (
  SELECT *, CASE {" ".join(f"WHEN {fit} THEN '{rule}'" for _, rule, fit in _FITS)} END AS rule,
         CASE {" ".join(f"WHEN {fit} THEN '{v}'" for v, _, fit in _FITS)} END AS decided
  FROM parts
), places AS (SELECT DISTINCT url, unnest(range(1, length(url) + 1)) AS i FROM ruled),
codes AS (
  SELECT url, i, CASE WHEN i < 3 THEN {START} ELSE strpos({_LETTER}, lower(url)[i - 2]) END AS a,
         CASE WHEN i < 2 THEN {START} ELSE strpos({_LETTER}, lower(url)[i - 1]) END AS b,
         strpos({_LETTER}, lower(url)[i]) AS c
  FROM places
), seen AS (
  SELECT a, b, c, {_in_classes("count(*) FILTER (decided = '@') AS @")}
  FROM ruled JOIN codes USING (url) WHERE decided IS NOT NULL AND md5(url) >= '{HELD_OUT}' GROUP BY ALL
), t AS (SELECT a, b, {_in_classes("sum(@) AS @")} FROM seen GROUP BY ALL),
bc AS (SELECT b, c, {_in_classes("sum(@) AS @")} FROM seen GROUP BY ALL),
b1 AS (SELECT b, {_in_classes("sum(@) AS @")} FROM seen GROUP BY ALL),
c1 AS (SELECT c, {_in_classes("sum(@) AS @")} FROM seen GROUP BY ALL),
o AS (SELECT {_in_classes("coalesce(sum(@), 0) AS @")} FROM seen),
zero AS (
  SELECT codes.*, {_in_classes(f"(coalesce(c1.@, 0) + {WEIGHT}::DOUBLE / {SIZE}) / (o.@ + {WEIGHT}::DOUBLE) AS @0")}
  FROM codes LEFT JOIN c1 USING (c), o
), one AS (
  SELECT zero.*, {_in_classes(f"(coalesce(bc.@, 0) + {WEIGHT}::DOUBLE * @0) / (coalesce(b1.@, 0) + {WEIGHT}::DOUBLE) AS @1")}
  FROM zero LEFT JOIN bc USING (b, c) LEFT JOIN b1 USING (b)
), two AS (
  SELECT one.*, {_in_classes(f"(coalesce(seen.@, 0) + {WEIGHT}::DOUBLE * @1) / (coalesce(t.@, 0) + {WEIGHT}::DOUBLE) AS @2")}
  FROM one LEFT JOIN seen USING (a, b, c) LEFT JOIN t USING (a, b)
), scores AS (SELECT url, round(avg(ln(allow2) - ln(block2)), 9) AS score FROM two GROUP BY url),
scored AS (SELECT ruled.*, coalesce(score, 0.0) AS score FROM ruled LEFT JOIN scores USING (url)),
spread AS (
  SELECT {_in_classes("avg(score) FILTER (decided = '@') AS mean_@, stddev_pop(score) FILTER (decided = '@') AS dev_@")}
  FROM scored WHERE md5(url) < '{HELD_OUT}'
), bound AS (
  SELECT round(CASE WHEN dev_allow + dev_block = 0 THEN (mean_allow + mean_block) / 2
               ELSE (mean_allow * dev_block + mean_block * dev_allow) / (dev_allow + dev_block) END, 9) AS cut
  FROM spread
)
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN score < cut THEN 'block' ELSE 'allow' END) AS verdict, score
FROM scored, bound
"""
