"""Best-fit packing."""

import random
from collections import defaultdict

from mercata.llm import packing

SCHEMA = "doc_id long, source string, text string, size int, cluster string, piece int, sequence string, group int"


def replay(places, sizes, sources, clusters, capacity):
    """Follow the placements, and check at every step that no compatible bin was tighter."""
    bins = {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        name, offset = places[i]
        fits = [
            b["left"] for b in bins.values()
            if b["left"] >= sizes[i] and sources[i] not in b["sources"] and clusters[i] not in b["clusters"]
        ]
        assert (name in bins) == bool(fits)
        mine = bins.setdefault(name, {"left": capacity, "sources": set(), "clusters": set()})
        assert mine["left"] == min(fits, default=capacity) == capacity - offset
        assert sources[i] not in mine["sources"] and clusters[i] not in mine["clusters"]
        mine["left"] -= sizes[i]
        mine["sources"].add(sources[i])
        mine["clusters"].add(clusters[i])


def test_finds_the_tightest_compatible_bin(monkeypatch):
    for tracked in (48, 2, 0):
        monkeypatch.setattr(packing, "TRACKED_SOURCES", tracked)
        for seed in range(15):
            rng = random.Random(seed)
            n = rng.randrange(1, 150)
            sizes = [rng.randrange(1, 65) for _ in range(n)]
            sources = [None if rng.random() < 0.1 else f"s{min(rng.randrange(9), 5)}" for _ in range(n)]
            clusters = [rng.randrange(n) // 3 for _ in range(n)]
            places = packing.packed(sizes, sources, clusters, 64)
            replay(places, sizes, sources, clusters, 64)


def test_packs_whole_documents(spark, frame, monkeypatch):
    monkeypatch.setattr(packing, "PACKED_ROWS", 100)
    rng = random.Random(4)
    rows = [
        (i, rng.choice(["a", "a", "b", "c", None]), "w " * rng.choice([0, 3, 10, 31, 32, 33, 100]) + str(i % 40), 1, "c", 2, "q", 3)
        for i in range(300)
    ]
    rows += [(7, "a", "same text", 1, "c", 2, "q", 3)] * 5 + [(None, None, None, 1, "c", 2, "q", 3)] * 2
    got = packing.pack(frame(rows, SCHEMA), capacity=32).collect()
    words, sequences = defaultdict(int), defaultdict(list)
    for r in got:
        words[r.doc_id] += r.n_words
        if r.sequence is None:
            assert r.size == 0 and r.n_words == 0
        else:
            sequences[r.sequence].append(r)
    want = defaultdict(int)
    for row in rows:
        want[row[0]] += len((row[2] or "").split())
    assert words == want and sum(r.sequence is None for r in got) == 2
    for members in sequences.values():
        members.sort(key=lambda r: r.offset)
        at = 0
        for r in members:
            assert r.offset == at
            at += r.n_words
        assert at == members[0].fill <= 32
        assert members[0].n_words == 32 or len({r.source for r in members}) == len(members)
    assert sum(r.doc_id == 7 and r.n_words == 2 for r in got) == 5
    assert packing.pack(frame([], SCHEMA)).collect() == []


def test_repeated_rows_of_several_capacities_are_packed_apart(spark, frame):
    """Equal rows, and rows of one id and text under other sources, share no sequence."""
    long, longer = "w " * 70, "v " * 96
    rows = [(7, s, long, 1, "c", 2, "q", 3) for s in ("a", "a", "a", "b", None, None)]
    rows += [(8, "a", longer, 1, "c", 2, "q", 3)] * 2 + [(None, None, long, 1, "c", 2, "q", 3)] * 2 + [(9, "b", "short text", 1, "c", 2, "q", 3)] * 3
    got = packing.pack(frame(rows, SCHEMA), capacity=32).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence].append(r)
    assert sum(r.n_words for r in got) == sum(len(row[2].split()) for row in rows)
    assert sum(r.n_words == 32 for r in got) == 8 * 2 + 2 * 3
    for members in sequences.values():
        assert sum(r.n_words for r in members) == members[0].fill <= 32
        assert len({r.source for r in members}) == len(members)
        assert len({(r.doc_id, r.size) for r in members}) == len(members)
        assert sorted(r.offset for r in members)[0] == 0
