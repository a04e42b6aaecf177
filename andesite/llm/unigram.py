"""Token counts under a unigram model, computed once per shared prefix of the words.

The pieces of a public vocabulary, ranked from frequent to rare, get Zipf probabilities; a word
(a run without ASCII blanks, with the vocabulary's word mark before it) is segmented into the
pieces with the largest product.  A character without a piece is spelled in bytes, one token each.

The distinct words of a slice of texts form a trie: sorted, each word keeps the states of the prefix
that it shares with the one before, so the best score and its number of tokens are computed once
per node.  The number at the last node of a word is its token count.

Among equal scores the segmentation with fewer tokens counts.  Null and empty texts have no words
and no tokens.  Repeated rows are counted each; a null doc_id stays null; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from andesite.llm.common import slices

WORD_MARK = "▁"


class Unigram:
    """Scores of the pieces of a vocabulary."""

    _loaded: dict[str, Unigram] = {}

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            (-model.get_score(i), i) for i in range(model.get_piece_size())
            if not (model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i))
        ]
        total = math.log(sum(1 / (r + 1) for r in range(len(plain) + 256)))
        self.score = {
            model.id_to_piece(i): -math.log(r + 1) - total for r, (_, i) in enumerate(sorted(plain))
        }
        self.byte_score = -math.log(len(plain) + 256) - total
        self.longest = max(map(len, self.score), default=1)

    @classmethod
    def at(cls, path: str) -> Unigram:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]


def count_tokens(words: list[str], model: Unigram) -> dict[str, int]:
    """Tokens of each distinct word; ``words`` are walked in trie order."""
    score, longest, get = model.score, model.longest, model.score.get
    counts: dict[str, int] = {}
    last = ""
    best, tokens = [0.0], [0]  # by node depth along the current path
    for word in sorted(words):
        marked = WORD_MARK + word
        shared, most = 0, min(len(last), len(marked))
        while shared < most and last[shared] == marked[shared]:
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(marked) + 1):
            c = marked[end - 1]
            if c in score:
                top, fewest = -math.inf, 0
            else:
                spelled = len(c.encode("utf-8", "replace"))
                top, fewest = best[end - 1] + spelled * model.byte_score, tokens[end - 1] + spelled
            for start in range(max(0, end - longest), end):
                s = get(marked[start:end])
                if s is not None:
                    s += best[start]
                    if s > top or (s == top and tokens[start] + 1 < fewest):
                        top, fewest = s, tokens[start] + 1
            best.append(top)
            tokens.append(fewest)
        counts[word] = tokens[-1]
        last = marked
    return counts


def token_counts(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_distinct_words, n_tokens) of each document."""
    path = tokenizer_path or public_tokenizers.path("piece_bpe_32k.model")
    names = ("n_words", "n_distinct_words", "n_tokens")
    schema = T.StructType(
        [docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in names]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram.at(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out: list[list[int]] = [[], [], []]
            for begin, end in slices(texts):
                docs_words = [
                    Counter((t or "").encode("utf-8", "replace").split()) for t in texts[begin:end]
                ]
                distinct = {w for words in docs_words for w in words}
                spelled = {w: w.decode("utf-8", "replace") for w in distinct}
                counts = count_tokens(list(spelled.values()), model)
                length = {w: counts[s] for w, s in spelled.items()}
                for words in docs_words:
                    out[0].append(words.total())
                    out[1].append(len(words))
                    out[2].append(sum(length[w] * n for w, n in words.items()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in out]], schema.names
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
