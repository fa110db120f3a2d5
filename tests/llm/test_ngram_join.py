"""N-gram Jaccard join against brute force."""

import random
import re

import pyarrow as pa
import pytest

from mercata.llm import graph, ngram_join, shingles

SCHEMA = "doc_id long, text string, doc string, n int, tokens int, component_id int, later int"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed, groups, copies, common=True, vocabulary=400):
    """Groups of near copies with few and many changed words, and a passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % vocabulary}"
    passage = " ".join(word() for _ in range(40))
    rows = []
    for g in range(groups):
        base = [f"{word()}{rng.randrange(4)}" for _ in range(rng.choice([4, 9, 16, 24, 60, 150, 400]))]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
                text[rng.randrange(len(text))] = word()
            tail = f" {passage}" if common and rng.random() < 0.4 else ""
            rows.append((len(rows), " ".join(text) + tail))
    rng.shuffle(rows)
    return rows


def found(frame, rows):
    extra = [(i, t, "x", 1, 2, 3, 4) for i, t in rows]
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_copies(frame(extra, SCHEMA)).collect()}


@pytest.mark.parametrize("seed,heavy,small", [(1, 32, None), (2, 3, None), (3, 2, 48), (4, 3, 20), (5, 32, 48), (6, 1, 0)])
def test_components_match_brute_force(spark, frame, monkeypatch, seed, heavy, small):
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    if small is not None:
        monkeypatch.setattr(ngram_join, "boundary", lambda *_: small)
    rows = corpus(seed, 60, 9)
    assert found(frame, rows) == brute(rows)


def test_large_group_of_near_copies(spark, frame):
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.choice([1, 2, 4, 6])):
            text[rng.randrange(120)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(text)))
    assert found(frame, rows) == brute(rows)


def test_threshold_is_met_exactly(spark, frame):
    """17 of 20 shingles in common is just enough, 16 of 19 is not."""
    w = [f"a{i}" for i in range(40)]
    rows = [(1, " ".join(w[:23])), (2, " ".join(w[:20])), (5, " ".join(w[20:39])), (6, " ".join(w[20:36]))]
    assert {i: c for i, (_, c) in found(frame, rows).items()} == {1: 1, 2: 1, 5: 5, 6: 6}
    assert found(frame, rows) == brute(rows)


def test_edges(spark, frame):
    assert found(frame, []) == {}
    rows = [
        (9, "One two three"), (4, "one TWO three"), (5, "one two"), (6, None), (7, ""), (8, " \t\n"), (3, "Ünï é x"), (2, "ünï é x"),
        (11, "long " * 30_000), (10, "long " * 20_000),
    ]
    assert found(frame, rows) == brute(rows)
    extra = [(1, "p q r s t", "x", 1, 2, 3, 4), (None, "p q r s t", "x", 1, 2, 3, 4), (1, "p q r s t", "x", 1, 2, 3, 4), (None, "only here", "x", 1, 2, 3, 4)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_copies(frame(extra, SCHEMA)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None)], key=str)


def test_one_of_each(spark, frame):
    rows = [(i, "a b c d e f g" if i % 2 else f"t{i} u v w", "x", 1, 2, 3, 4) for i in range(9)] + [(0, "t0 u v w", "x", 1, 2, 3, 4), (None, "z", "x", 1, 2, 3, 4)]
    out = ngram_join.one_of_each(frame(rows, SCHEMA))
    assert out.columns == frame(rows, SCHEMA).columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([0, 1, 2, 4, 6, 8, None], key=str)


def test_boundary_takes_the_cheapest_size():
    class Counts:
        def __init__(self, scan):
            self.get = {f"scan_{at}": s for at, s in zip(ngram_join.BOUNDARIES, scan)}

    sizes = [(10, 3, 1000), (40, 8, 10)]
    assert ngram_join.boundary(Counts([9e9, 0, 0, 0, 0]), sizes) == 13
    assert ngram_join.boundary(Counts([0] * 5), [(40, 8, 1000)]) < 48


def test_shingle_hashes_are_as_distinct_as_words():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aAbé \t\n\x0b 𝔘") for _ in range(rng.randrange(60))) for _ in range(500)] + [None, "x" * 100_000]
    got = [set(s.tolist()) for s in shingles.shingle_sets(pa.array(texts))]
    want = [shingle_set(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for i in range(0, 500, 7):
        for j in range(0, 500, 11):
            assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_components_of_chains_and_stars(spark, frame):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 150), (150, 200)]
    got = {r.node: r.component for r in graph.components(frame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 150: 150, 200: 150}
    assert graph.components(frame([], "a long, b long")).collect() == []


def brute_of(rows, size, share):
    """Smallest reachable id of every row by runs of ``size`` words and ``share`` hundredths."""
    sets = []
    for i, text in rows:
        w = words_of(text)
        sets.append((i, {tuple(w[j:j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())))
    links = [
        (i, j) for x, (i, a) in enumerate(sets) for j, b in sets[:x] if a and b and 100 * len(a & b) >= share * len(a | b)
    ]
    least, changed = {i: i for i, _ in rows}, True
    while changed:
        changed = False
        for i, j in links:
            low = min(least[i], least[j])
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    return {i: (len(s), least[i]) for i, s in sets}


@pytest.mark.parametrize("seed,heavy,small,size,share", [
    (1, 32, None, 5, 80), (2, 3, 48, 5, 80), (3, 2, 20, 5, 80), (4, 1, 0, 5, 80), (5, 32, 48, 2, 51), (6, 3, None, 3, 95),
])
def test_other_words_and_shares_match_brute_force(spark, frame, monkeypatch, seed, heavy, small, size, share):
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    if small is not None:
        monkeypatch.setattr(ngram_join, "boundary", lambda *_: small)
    rows = corpus(seed + 20, 60, 9)
    extra = [(i, t, "x", 1, 2, 3, 4) for i, t in rows]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_copies(frame(extra, SCHEMA), size, share).collect()}
    assert got == brute_of(rows, size, share)


def test_pipeline_drops_near_copies_of_five_words_and_four_fifths(spark, frame):
    """One word of 50 differs: 41 of 51 runs of five are common (0.80), 43 of 51 of four (0.84)."""
    import corpus_pipeline

    w = [f"a{i}" for i in range(50)]
    rows = [(1, " ".join(w)), (2, " ".join([*w[:25], "other", *w[26:]])), (3, "something else altogether")]
    rows += [(i + 10, t) for i, t in corpus(31, 40, 9)]
    out = corpus_pipeline.drop_near_copies(spark, frame([(i, t, "x", 1, 2, 3, 4) for i, t in rows], SCHEMA), None)
    kept = {r.doc_id for r in out.collect()}
    assert kept == {c for _, c in brute_of(rows, 5, 80).values()} != {c for _, c in brute(rows).values()}
    assert 1 in kept and 2 not in kept
