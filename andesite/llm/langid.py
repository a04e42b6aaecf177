"""Language proportions of texts by expectation-maximisation over n-gram likelihoods.

Training counts the letter n-grams (``ORDER`` letters, case folded, other characters as blanks) of
each language, hashed into ``BUCKETS``, with additive smoothing.  For a text, consecutive n-grams
form segments of ``SEGMENT``; a segment has a likelihood under each language, and EM estimates the
proportions of the languages that its segments are drawn from.  Sets of languages are compared by
penalised likelihood (half the log of the number of segments per further language): the best
language alone, the best two, and so on in the order of the proportions over all languages.  The
predicted language has the largest proportion in the chosen set.

A model holds one row of ``BUCKETS`` numbers per language and is bounded: more than
``MAX_LANGUAGES`` languages are an error.

Null texts and texts without a letter are ``und`` with score 0, as are all texts if no language was
learned.  Training leaves out null texts and null languages.  Ties go to the smaller language name.
Repeated rows are judged each; a null doc_id stays null; further columns are ignored; an empty
table gives no rows.  Long texts are read whole, in slices.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from andesite.llm.common import slices

ORDER = 3
BUCKETS = 1 << 16
SEGMENT = 48
SMOOTHING = 0.1
MAX_LANGUAGES = 512
ROUNDS = 12
SLICE = 500_000
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def folded_letters() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else 0; built once per worker."""
    if not _letters:
        fold = np.zeros(sys.maxunicode + 1, np.uint32)
        for i in range(len(fold)):
            c = chr(i)
            if c.isalpha():
                lower = c.lower()
                fold[i] = ord(lower) if len(lower) == 1 else i
        _letters.append(fold)
    return _letters[0]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams with a letter in the middle, where each text's begin, letters per text."""
    parts = [(t or "").encode("utf-32-le", "replace") for t in texts]
    gap = b"\0" * 4
    codes = np.frombuffer(gap + gap.join(parts) + gap, "<u4")
    letters = folded_letters()[codes]
    if len(letters) < ORDER:  # a single empty text
        none = np.zeros(len(texts), np.int64)
        return none[:0], none, none
    h = letters[:-2] * np.uint32(0x9E3779B1)
    h ^= letters[1:-1] * np.uint32(0x85EBCA77)
    h += h << np.uint32(7)
    h ^= letters[2:] * np.uint32(0xC2B2AE3D)
    h *= np.uint32(0x27D4EB2F)
    middle = letters[1:-1] != 0
    sizes = np.array([len(p) // 4 + 1 for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    per_text = np.add.reduceat(middle.astype(np.int64), np.minimum(starts, len(middle) - 1))
    per_text[starts >= len(middle)] = 0
    return (h[middle] >> np.uint32(16)).astype(np.int64), np.cumsum(per_text) - per_text, per_text


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all documents with text and language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for begin, end in slices(texts, SLICE):
                buckets, starts, sizes = ngrams(texts[begin:end])
                for lang in set(langs[begin:end]):
                    own = np.repeat([x == lang for x in langs[begin:end]], sizes)
                    seen = np.bincount(buckets[own], minlength=BUCKETS)
                    counts[lang] = counts[lang] + seen if lang in counts else seen
        for lang, seen in counts.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    counted = rows.mapInArrow(run, "lang string, bucket int, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Languages in order of name, and log-likelihoods of each bucket under them."""

    languages: list[str]
    logs: np.ndarray  # (BUCKETS, languages), float32


def train(docs: DataFrame) -> Model:
    """Learn from the ``text`` and ``lang`` of all given documents."""
    # One row per language and bucket at most: MAX_LANGUAGES * BUCKETS, never more with more data.
    languages = [r[0] for r in docs.filter("text IS NOT NULL AND lang IS NOT NULL")
                 .select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    languages.sort()
    counts = np.zeros((BUCKETS, len(languages)))
    if languages:
        rows = count_ngrams(docs).toPandas()
        counts[rows["bucket"], np.searchsorted(languages, rows["lang"])] = rows["n"]
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(0)).astype(np.float32))


def _em(like: np.ndarray, top: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray):
    """Proportions of each text over its allowed languages, and its log-likelihood.

    ``like`` has the likelihood of each segment relative to its largest, ``top`` the log of that.
    """
    share = allowed / allowed.sum(1, keepdims=True)
    of = np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(ROUNDS):
        weight = share[of] * like
        weight /= weight.sum(1, keepdims=True)
        share = np.add.reduceat(weight, starts) / sizes[:, None]
        share[share < 1e-6] = 0
    logs = np.log((share[of] * like).sum(1)) + top
    return share, np.add.reduceat(logs, starts)


def infer(texts: list[str | None], model: Model) -> list[tuple[str, float, str, float]]:
    """Language, score, the chosen set with proportions, and what that set has in the text's proportions
    over all languages."""
    found: list[tuple[str, float, str, float]] = [(UNKNOWN, 0.0, "", 0.0)] * len(texts)
    buckets, begin, sizes = ngrams(texts)
    known = np.flatnonzero(sizes)
    if not len(known) or not model.languages:
        return found
    # Segment borders: every SEGMENT n-grams from the start of each text.
    per_text = -(-sizes[known] // SEGMENT)
    first = np.cumsum(per_text) - per_text
    number = np.arange(per_text.sum()) - np.repeat(first, per_text)
    borders = np.repeat(begin[known], per_text) + number * SEGMENT
    # Overlapping n-grams repeat each letter ORDER times.
    logs = np.add.reduceat(model.logs[buckets], borders).astype(np.float64) / ORDER
    top = logs.max(1)
    like = np.maximum(np.exp(logs - top[:, None]), 1e-12)
    whole, _ = _em(like, top, first, per_text, np.ones((len(known), len(model.languages))))
    order = np.argsort(-whole, axis=1, kind="stable")
    best_value = np.full(len(known), -np.inf)
    best_share = whole
    allowed = np.zeros_like(whole)
    for n in range(len(model.languages)):
        new = whole[np.arange(len(known)), order[:, n]] > 0
        if n and not new.any():
            break
        allowed[np.arange(len(known)), order[:, n]] = 1
        share, value = _em(like, top, first, per_text, allowed)
        value -= 0.5 * n * np.log(per_text + 1)
        better = (value > best_value + 1e-9) & (new | (n == 0))
        best_value = np.where(better, value, best_value)
        best_share = np.where(better[:, None], share, best_share)
    for i, at in enumerate(known):
        share = best_share[i]
        chosen = sorted(np.flatnonzero(share > 0), key=lambda j: (-share[j], j))
        names = ",".join(f"{model.languages[j]}:{share[j]:.3f}" for j in chosen)
        found[at] = (model.languages[chosen[0]], float(min(1.0, whole[i, chosen[0]])), names, float(whole[i, chosen].sum()))
    return found


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, languages); only ``text`` is an input of a prediction."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("languages", T.StringType()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [x for b, e in slices(texts, SLICE) for x in infer(texts[b:e], shared.value)]
            columns = [pa.array(c, k) for c, k in zip(list(zip(*found))[:3], (pa.string(), pa.float64(), pa.string()))]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents, unchanged, whose chosen languages explain at least the share ``least`` of the text.

    A text in several languages is kept if they are in its set, however small the share of each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def known(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            texts = column.to_pylist()
            found = [x for b, e in slices(texts, SLICE) for x in infer(texts[b:e], shared.value)]
            yield pa.array([x[0] != UNKNOWN and x[3] >= least for x in found], pa.bool_())

    # Only texts go to Python and one bit a row comes back; the rows themselves stay where they are.
    return docs.filter(known("text"))
