"""Quality rules: what a public tokenizer makes of a text, against bands of its language.

Plain counts first (words are runs without ASCII blanks):

n_words, word_chars   words, and code points in them
n_symbols             characters of ``#*$%&|<>``
n_dup_lines           lines with a word that equal an earlier line
n_repeat_words        words in 3-word windows found twice or more in the text, the first included
base_failed           fewer than 50 words, or more than half of them repeated

Then the fertility of the words under a vocabulary with byte fallback:

chars_per_token       code points in words for each token
byte_share            share of tokens that are single bytes for want of a piece
evenness              entropy of the tokens over the largest that so many tokens can have

Bands are learned from all texts that pass the base: for each language (where it is null, for the
script most letters are of) the quartiles of each figure, widened on both sides by three times
their distance and by no less than ``LEAST_MARGIN``.  A text outside a band of its group is
rejected.  Quartiles come from whole histograms of figures rounded to thousandths, so they do not
depend on partitions.  A group of which no text passes the base has no bands and rejects nothing.

Null and empty texts have no words and fail the base.  Repeated rows are judged each; a null doc_id
stays null; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from andesite.llm.common import BLANKS, MEMORY_WORDS, WordHashes, byte_words, stage, window_hashes

SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
FIGURES = ("chars_per_token", "byte_share", "evenness")
LEAST_MARGIN = {"chars_per_token": 0.25, "byte_share": 0.05, "evenness": 0.1}
QUARTILE_MARGIN = 3.0
STEPS = 1000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")


class Fertility(dict):
    """The ids of a word as 32-bit numbers, computed once while the word is remembered."""

    _loaded: dict[str, Fertility] = {}

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.IsByte(i) for i in range(self.model.get_piece_size())])

    @classmethod
    def at(cls, path: str) -> Fertility:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.model.encode(word.decode("utf-8", "replace"))
        value = self[word] = np.array(ids, "<u4").tobytes()
        return value

    def tokens(self, words: list[bytes]) -> np.ndarray:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u4")


def script_of(text: str | None) -> str:
    """The script most letters of a text are of, named as in their Unicode names; else ``none``."""
    seen = Counter(c for c in text or "" if c.isalpha())
    scripts: Counter[str] = Counter()
    for c, n in seen.items():
        scripts[unicodedata.name(c, "OTHER").split(" ")[0].split("-")[0].lower()] += n
    return max(sorted(scripts), key=scripts.get, default="none")


def repeated_words(hashes: np.ndarray, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found at least twice."""
    if len(hashes) <= size:
        return 0
    windows = window_hashes(hashes, size)
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[which] > 1)
    inside = np.zeros(len(hashes), bool)
    for j in range(size):
        inside[again + j] = True
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def measure(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Counts and figures of each document; its group is ``lang``, or the script if that is null."""
    has_lang = "lang" in docs.columns
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("group", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in COUNTS],
        *[T.StructField(c, T.DoubleType()) for c in FIGURES],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words_seen = Fertility.at(tokenizer_path), WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs = batch.column("lang").to_pylist() if has_lang else [None] * len(texts)
            out: list[list] = [[] for _ in (*COUNTS, *FIGURES)]
            groups = []
            for text, lang in zip(texts, langs):
                text = text or ""
                groups.append(lang if lang is not None else script_of(text))
                words = byte_words(text)
                chars = len(text) - sum(map(text.count, BLANKS))
                tokens = model.tokens(words)
                n = len(tokens)
                byte_tokens = entropy = 0.0
                if n:
                    byte_tokens = float(model.is_byte[tokens].sum())
                    share = np.bincount(tokens)
                    share = share[share > 0] / n
                    entropy = float(-(share * np.log2(share)).sum())
                most = np.log2(min(n, len(model.is_byte))) if n > 1 else 1.0
                row = (
                    len(words), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text),
                    repeated_words(words_seen.of(words)), n,
                    chars / n if n else 0.0, byte_tokens / n if n else 0.0, entropy / most,
                )
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(FIGURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(groups, pa.string()),
                 *[pa.array(c, k) for c, k in zip(out, kinds)]], schema.names)

    columns = ["doc_id", "text", "lang"] if has_lang else ["doc_id", "text"]
    return docs.select(*columns).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def bands(measured: DataFrame) -> DataFrame:
    """(group, figure, low, high): one row per language or script and figure."""
    figures = F.explode(F.array(*[
        F.struct(F.lit(f).alias("figure"), F.rint(F.col(f) * STEPS).cast("bigint").alias("step"))
        for f in FIGURES
    ]))
    counts = (
        measured.filter(~base_failed()).select("group", figures.alias("x"))
        .groupBy("group", "x.figure", "x.step").count()
    )
    group = Window.partitionBy("group", "figure")
    upto = F.sum("count").over(group.orderBy("step"))
    whole = F.sum("count").over(group)
    ranked = counts.select("group", "figure", "step", upto.alias("upto"), whole.alias("whole"))

    def quartile(q: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= q * F.col("whole"), F.col("step"))) / STEPS

    margin = F.coalesce(*[F.when(F.col("figure") == f, F.lit(m)) for f, m in LEAST_MARGIN.items()])
    wide = F.greatest(QUARTILE_MARGIN * (F.col("q3") - F.col("q1")), margin)
    return (
        ranked.groupBy("group", "figure").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
        .select("group", "figure", (F.col("q1") - wide).alias("low"), (F.col("q3") + wide).alias("high"))
    )


def judge(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Counts, figures and verdict of each document; texts are tokenized once."""
    path = tokenizer_path or public_tokenizers.path("piece_bpe_32k.model")
    measured = stage(measure(docs, path), "fertility")
    ends = [
        F.max(F.when(F.col("figure") == f, F.col(end))).alias(f"{f}_{end}")
        for f in FIGURES for end in ("low", "high")
    ]
    limits = bands(measured).groupBy("group").agg(*ends).withColumnRenamed("group", "of")
    outside = [
        (F.col(f) < F.col(f"{f}_low")) | (F.col(f) > F.col(f"{f}_high")) for f in FIGURES
    ]
    rejected = F.coalesce(outside[0] | outside[1] | outside[2], F.lit(False))
    return measured.join(limits, F.col("group") == F.col("of"), "left").select(
        "doc_id", *COUNTS, *FIGURES, "group", base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
    )
