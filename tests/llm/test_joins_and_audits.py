"""Centroids, source divergence and the n-gram join against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from andesite.llm import centroids, divergence, ngram_join
from andesite.llm.common import table
from test_text_operators import DOCS, SF_DIR, awkward, nothing, plain_groups  # noqa: F401  (fixtures)

VECTORS = "vec_id bigint, embedding array<float>, label int, cluster int, v int"


# --- centroids ---------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dimensions):
    whole = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
             if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)]
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    first = sorted(whole, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]
    centres = [v for _, v in first]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in whole:
            members[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c
                   for n, c in enumerate(centres)]
    assigned = [(i, nearest(v)) for i, v in whole]
    inertia = Counter()
    for _, (d, n) in assigned:
        inertia[n] += d
    return sorted(
        ((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
         for i, (d, n) in assigned), key=repr)


def awkward_vectors():
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 2, 3)]) for i in range(60)]
    rows += [(60, None), (61, []), (62, [1.0, 2.0]), (63, [1.0, None, 2.0]), (64, [1.0, float("nan"), 0.0]),
             (65, [1.0, float("inf"), 0.0]), (None, [0.5, 0.25, -0.125]), rows[3], rows[3], (3, [9.0, 9.0, 9.0]),
             (66, [1e-30, -1e-30, -0.0])]
    return rows


@pytest.mark.parametrize("k,rounds", [(5, 4), (1, 1), (200, 2), (7, 0)])
def test_clusters_match_plain_loops(spark, k, rounds):
    rows = awkward_vectors()
    df = spark.createDataFrame([(i, e, None, 1, 2) for i, e in rows], VECTORS).repartition(3)
    got = sorted((tuple(r) for r in centroids.cluster(df, k, rounds, 3).collect()), key=repr)
    assert got == plain_clusters(rows, k, rounds, 3) and len(got) == 65


def test_equal_vectors_leave_later_centroids_empty(spark):
    """Ties go to the smaller number; empty centroids stay where they are."""
    df = spark.createDataFrame([(i, [1.0, -1.0], None, None, None) for i in range(20)], VECTORS)
    got = centroids.cluster(df, 4, 3, 2).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)} and len(got) == 20


def test_no_vectors_give_no_rows(spark):
    df = spark.createDataFrame([], VECTORS)
    assert centroids.cluster(df).collect() == []
    assert centroids.cluster(spark.createDataFrame([(1, [1.0], 1, 1, 1)], VECTORS)).schema.simpleString().startswith(
        "struct<vec_id:bigint,cluster:int,distance:bigint")


def test_rounds_stay_in_the_jvm_and_shuffle_one_row_per_cluster(spark, capsys):
    df = spark.createDataFrame([(i, [1.0, float(i)], None, None, None) for i in range(20)], VECTORS)
    whole = centroids.whole_vectors(df, 2)
    near = centroids.nearest([[1, 2], [3, 4]])
    whole.groupBy(near["cluster"].alias("c")).count().explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and plan.count("HashAggregate") == 2


# --- divergence --------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_divergence(rows, least_docs, top):
    seen, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        seen[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs.keys() | {k[0] for k in seen}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        own = {s: c for (l, s), c in seen.items() if l == lang}
        whole = Counter()
        for c in own.values():
            whole.update({t: c[t] for t in kept})

        def price(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = price(whole), {s: price(c) for s, c in own.items()}
        for s in own:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            out += [(lang, s, "pair", o, -v, n) for n, (v, _, o) in enumerate(sorted(pairs), 1)]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "term", t, -v, n) for n, (v, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,bundle", [(divergence.BLOCK, divergence.BUNDLE), (3, 2)])
def test_divergence_matches_plain_counts(spark, monkeypatch, block, bundle):
    """Also with many blocks and bundles; with languages of one source and without kept terms."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "BUNDLE", bundle)
    rng = np.random.default_rng(2)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)] + ["Äpfel", " ", "naïve", "İ", "日本"]
    rows = []
    for i in range(300):
        size = int(rng.integers(0, 40))
        text = " 1-".join(words[int(x)] for x in np.minimum(rng.zipf(1.3, size), len(words)) - 1)
        rows.append((text if size else [None, "", " 12 "][i % 3], [None, "", "de", "EN"][i % 4], [None, "", "a", "b", "ü", "Z"][i % 6]))
    rows += [("lonely lonely words", "xx", "one")] * 5 + [(None, "yy", "one"), ("", "yy", "two"), rows[0], rows[0]]
    docs = spark.createDataFrame([(1, t, l, s, None, 1, "k", 9) for t, l, s in rows], DOCS).repartition(5)
    got = sorted(tuple(r) for r in divergence.divergence(docs, 8, 4).collect())
    want = plain_divergence(rows, 8, 4)
    assert got == want and {r[2] for r in got} == {"pair", "term"} and ("yy", "one", "pair", "two", 0, 1) in got


def test_divergence_of_awkward_rows(spark, awkward, nothing):  # noqa: F811
    rows = [(r.text, r.lang, r.source) for r in awkward.collect()]
    got = sorted(tuple(r) for r in divergence.divergence(awkward, 2, 50).collect())
    assert got == plain_divergence(rows, 2, 50)
    assert divergence.divergence(nothing).count() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    raw = "Ab cd-ef é1gh ".encode() * 40 + b"x" * 200
    whole = [t.encode() for t in TERM.findall(raw.decode().translate(LOWER))]
    for cut in (1, 7, 50, 10**6):
        monkeypatch.setattr(divergence, "CUT", cut)
        pieces = list(divergence.text_pieces(raw))
        assert [t for p in pieces for t in p] == whole and (cut == 10**6) == (len(pieces) == 1)


@settings(deadline=None, max_examples=200)
@given(st.sets(st.integers(0, 400), max_size=80), st.sets(st.integers(0, 400), max_size=300), st.integers(1, 40))
def test_galloping_finds_the_common_members(a, b, run):
    small, large = (np.array(sorted(x), np.int64) for x in (a, b))
    at = divergence.gallop(small, large, run)
    assert [int(s) for s, p in zip(small, at) if p >= 0] == sorted(a & b)
    assert all(large[p] == s for s, p in zip(small, at) if p >= 0)


@settings(deadline=None, max_examples=200)
@given(st.integers(0, 9 * 10**12), st.integers(0, 10**12), st.integers(1, 10**6))
def test_prices_are_exact(count, more, terms):
    total = count + more
    got = divergence.prices(np.array([count]), total, terms)[0]
    assert got == 1 + 10**9 * (count + 5) // (total + 5 * terms)


def test_prices_in_sql_are_the_same(spark):
    rows = [(0, 0, 1), (0, 9 * 10**15 - 100, 7), (9 * 10**15 - 100, 9 * 10**15 - 100, 7), (12345, 99999, 321)]
    df = spark.createDataFrame(rows, "n bigint, total bigint, terms bigint")
    got = [r[0] for r in df.selectExpr(divergence.price_sql("n", "total", "terms")).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in rows]


# --- n-gram join -------------------------------------------------------------------------


def joined(df):
    return {r.doc_id: tuple(r) for r in df.collect()}


def test_ngram_join_matches_all_pairs(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = plain_groups({r[0]: r[1] for r in docs.select("doc_id", "text").collect()}, 80)
    got = joined(ngram_join.ngram_components(docs))
    assert got == {d: r[:3] for d, r in want.items()} and any(not r[3] for r in want.values())


@pytest.mark.parametrize("block,percents", [(ngram_join.BLOCK, (85, 100)), (7, (80,))])
def test_chains_and_templates_in_large_tiles(spark, monkeypatch, block, percents):
    """Chains whose ends are not similar, a family just under the threshold, copies; tiles cut into blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = np.random.default_rng(3)
    texts = {}
    words = [f"w{i}" for i in range(200)]
    for i in range(90):
        texts[i] = " ".join(words)
        words[int(rng.integers(0, 200))] = f"x{i}"
    words = [f"t{i}" for i in range(150)]
    for i in range(60):  # one inner word costs 5 of 146 runs: two members differ by up to 36
        own = list(words)
        for at in rng.permutation(140)[:3]:
            own[at] = f"y{i}-{at}"
        texts[500 + i] = " ".join(own[: 150 - i % 9])
    texts |= {1000 + i: "one text that is copied many times over" for i in range(50)}
    texts |= {2000 + i: " ".join(["a b c d e f g h"[: 2 * i + 1]]) for i in range(8)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    for percent in percents:
        want = plain_groups(texts, percent)
        assert joined(ngram_join.ngram_components(docs, percent)) == {d: r[:3] for d, r in want.items()}
        assert len({r[2] for r in want.values()}) < len(texts)


@pytest.mark.parametrize("sets", [1 << 21, 1000])
def test_near_copies_under_the_threshold_are_not_handed_on_in_pairs(spark, monkeypatch, sets):
    """A family whose members pass by their bitmaps and are no links: rows handed on do not grow with its square."""
    rng = np.random.default_rng(5)
    words = [f"t{i}" for i in range(600)]
    texts = {}
    for i in range(40):  # eight inner words cost 40 of 596 runs: most pairs share 516 of 676
        own = list(words)
        for at in rng.choice(np.arange(5, 595, 5), 8, replace=False):
            own[at] = f"y{i}-{at}"
        texts[i] = " ".join(own)
    texts |= {100 + i: f"{texts[2 * i]} more" for i in range(10)}
    handed = []

    def counted(name):
        operator = getattr(ngram_join, name)

        def run(rows, *others):
            handed.append(rows.count())
            return operator(rows, *others)

        monkeypatch.setattr(ngram_join, name, run)

    counted("confirmed")
    if hasattr(ngram_join, "joins"):
        counted("joins")
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    got = joined(ngram_join.ngram_components(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")))
    assert got == {d: r[:3] for d, r in plain_groups(texts, 80).items()}
    assert len({r[2] for r in got.values()}) > 10 and len(handed) > ngram_join.ROUNDS
    assert max(handed) <= 2 * len(texts)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=20), st.data())
def test_joined_labels_are_the_smallest_that_hang_together(labels, data):
    row = st.integers(0, len(labels) - 1)
    pairs = data.draw(st.lists(st.tuples(row, row), max_size=12))
    want = list(labels)
    for x, y in pairs:
        low, high = sorted((want[x], want[y]))
        want = [low if label == high else label for label in want]
    x, y = (np.array([p[side] for p in pairs], np.int64) for side in (0, 1))
    assert ngram_join.joined_labels(np.array(labels), x, y).tolist() == want


@settings(deadline=None, max_examples=100)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1), min_size=2, max_size=8), st.integers(1, 100))
def test_similar_sets_share_enough_members(sets, percent):
    own, *others = (np.array(sorted(s), np.uint64) for s in sets)
    want = [100 * len(sets[0] & s) >= percent * len(sets[0] | s) for s in sets[1:]]
    assert ngram_join.similar(own, others, percent).tolist() == want


def test_ngram_join_of_awkward_rows(spark, awkward, nothing):  # noqa: F811
    rows = ngram_join.ngram_components(awkward).collect()
    assert len(rows) == awkward.count()
    got = {r.doc_id: tuple(r) for r in rows}
    assert [got[i] for i in (0, 1, 2)] == [(i, 0, i) for i in (0, 1, 2)]
    assert got[12] == (12, 10, 11) and got[None] == (None, 1, None)
    assert ngram_join.ngram_components(nothing).count() == 0


def test_a_repeated_id_is_one_document(spark):
    """Links of any of its texts are links of the document."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, a), (5, b), (2, f"{a} more"), (3, f"{b} more"), (9, "alone"), (9, "alone")]
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [
        (2, 57, 2), (3, 57, 2), (5, 56, 2), (5, 56, 2), (9, 1, 9), (9, 1, 9)]


HASHES = st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300)


@settings(deadline=None, max_examples=100)
@given(HASHES, HASHES, HASHES)
def test_bitmaps_bound_the_overlap_from_above(common, a, b):
    x, y = (np.array(sorted(common | s), np.uint64) for s in (a, b))
    maps = [ngram_join.bitmap(s) for s in (x, y)]
    width = min(map(len, maps))
    most = ngram_join.overlap_bound(ngram_join.fold(maps[0], width), len(x), ngram_join.fold(maps[1], width), len(y))
    shared = len(np.intersect1d(x, y))
    assert shared <= most <= min(len(x), len(y))
    similar = 100 * shared >= 80 * (len(x) + len(y) - shared)
    n, first, second = np.array([len(x), len(y)]), np.array([0, 1]), np.array([1, 0])
    assert not similar or ngram_join.passing(n, maps, first, second, 80).all()


def test_bitmaps_compared_at_once_change_no_result(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(rng.integers(0, 2**63, 1500, dtype=np.uint64), size)) for size in rng.integers(100, 1400, 30)]
    n, maps = np.array([len(s) for s in sets]), [ngram_join.bitmap(s) for s in sets]
    x, y = np.triu_indices(len(sets), 1)
    want = ngram_join.passing(n, maps, x, y, 30)
    monkeypatch.setattr(ngram_join, "MAP_BYTES", 3000)
    assert (ngram_join.passing(n, maps, x, y, 30) == want).all() and len(set(map(len, maps))) > 2


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=12), st.integers(1, 30))
def test_strips_hold_every_pair_of_a_tile_once(sizes, strip):
    keys = [k for k, size in enumerate(sizes) for _ in range(size)]
    n = len(keys)
    same = ngram_join.bitmap(np.array([1], np.uint64))
    table = ngram_join.pa.table({
        "lead": np.zeros(n, np.int64), "key": np.array(keys, np.int64), "tile": np.zeros(n, np.int32), "i": np.zeros(n, np.int64), "j": np.zeros(n, np.int64),
        "class": np.arange(n), "label": np.arange(n), "own": np.zeros(n, np.int64), "n": np.ones(n, np.int64),
        "upper": np.ones(n, bool), "bitmap": ngram_join.pa.array([same] * n, ngram_join.pa.binary())})
    before, ngram_join.STRIP = ngram_join.STRIP, strip
    try:
        got = [p for x, y in ngram_join.Tiles(table).pairs(80) for p in zip(x.tolist(), y.tolist())]
    finally:
        ngram_join.STRIP = before
    assert sorted(got) == [(x, y) for x in range(n) for y in range(x + 1, n) if keys[x] == keys[y]]


@settings(deadline=None, max_examples=200)
@given(st.integers(1, 3000), st.integers(1, 100))
def test_sets_without_a_common_key_are_too_different(n, percent):
    """Of a set of n members at most n - keys can be shared if no key is."""
    keys = ngram_join.n_keys(n, percent)
    assert 1 <= keys <= n and 100 * (n - keys) < percent * n
