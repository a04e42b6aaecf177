"""The pipeline: each stage's decisions, and the whole of it on the supplied documents."""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from andesite.llm import near_dup, pii
from andesite.llm.common import stage, table
from test_text_operators import DOCS, check_pieces, plain_groups

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not available")


def test_stages_one_after_the_other(spark):
    docs = table(spark, SF_DIR, "documents")
    seen = {r.doc_id: r.asDict() for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES:
        before = {r.doc_id: r.asDict() for r in docs.collect()}
        result = stage(function(spark, docs, SF_DIR), name)
        if name == "packing":
            copies, seen_pieces, pieces = Counter(r.doc_id for r in docs.collect()), Counter(), []
            for r in result.collect():
                seen_pieces[r.doc_id, r.start] += 1
                pieces.append({**r.asDict(), "doc_id": (r.doc_id, seen_pieces[r.doc_id, r.start])})
            check_pieces(pieces, {(d, n + 1): before[d]["text"] for d, most in copies.items() for n in range(most)}, 1024)
            continue
        assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id: r.asDict() for r in result.collect()}
        assert len(after) == result.count() or name == "mixing"
        if name == "language":
            assert len(after) >= 0.98 * len(before) and all(before[d] == r for d, r in after.items())
        if name == "near_dup":
            groups = plain_groups({d: r["text"] for d, r in before.items()}, corpus_pipeline.NEAR_PERCENT)
            assert set(after) == {d for d, g in groups.items() if g[3]}
        if name == "pii":
            assert set(after) == set(before)
            for d, r in after.items():
                spans = pii.find_spans(before[d]["text"])
                assert r["text"] == pii.redact(before[d]["text"], spans)
                assert not [s for s in pii.find_spans(r["text"]) if s[0] in pii.BASE_KINDS] and r["n_chars"] == len(r["text"])
        if name == "mixing":
            words, taken = Counter(), Counter()
            for r in before.values():
                words[r["source"]] += max(1, len(r["text"].split()))
            for r in result.collect():
                taken[r.source] += max(1, len(r.text.split()))
            assert after == before and max(Counter(r.doc_id for r in result.collect()).values()) <= corpus_pipeline.MAX_REPEATS
            most = max(words, key=words.get)
            assert taken[most] == words[most] and taken[most] / taken.total() < words[most] / words.total()
        docs = result
    assert set(seen) >= set(before)


def test_run_is_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and set(rows[0].asDict()) == {
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_empty_and_awkward_documents(spark, tmp_path):
    rows = [(None, None, None, None, None, 1, "k", 2), (1, "", None, "s", 0, 1, "k", 2), (2, "abc def", "en", None, 7, 1, "k", 2),
            (2, "abc def", "en", None, 7, 1, "k", 2), (3, "word " * 5000, "en", "s", None, None, None, None)]
    for n, own in enumerate((rows, [])):
        spark.createDataFrame(own, DOCS).write.parquet(f"{tmp_path}/{n}/documents.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{n}").count() >= 0


def kept_of_all_pairs(texts, percent):
    """The smallest doc_id of each group, by the word runs of all pairs."""
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, t in texts.items() if (w := t.lower().split())}
    group = {d: d for d in texts}
    for a, b in combinations(sorted(sets), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if group[a] != group[b] and 100 * small >= percent * large:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (small + large - common):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    return {d for d, g in group.items() if d == g}


def test_near_duplicates_are_dropped_from_four_fifths_on(spark):
    rng = np.random.default_rng(5)
    texts = {}
    for i in range(300):
        words = [f"w{n}" for n in rng.integers(0, 5000, rng.integers(40, 160))]
        texts[2 * i] = " ".join(words)
        for at in rng.integers(0, len(words), rng.integers(1, 4)):
            words[at] = f"x{i}"
        texts[2 * i + 1] = " ".join(words)
    words = [f"v{n}" for n in range(60)]
    texts |= {1000: " ".join(words), 1001: " ".join([*words[:30], "other", *words[31:]])}  # 51 of 61 runs
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()}
    want = kept_of_all_pairs(texts, 80)
    assert got == want and 1001 not in got and len(want) < len(kept_of_all_pairs(texts, 85))
    docs = table(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()}
    assert got == kept_of_all_pairs(texts, 80)
    assert near_dup.layout(85) == (85, 7, 90, 817)
