"""Sharding and mixing."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from mercata.llm import mixing, sharding

DOCS = "doc_id long, source string, text string, shard int, mix int, size int, block int, key string"


def rows(n):
    return [(i, f"s{i % 3}" if i % 3 else "s0", "w " * (i % 7), 1, 2, 3, 4, "k") for i in range(n)]


def test_feistel_is_a_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 10, 97, 1000, 4097):
        steps = sharding.walk_length(spark, n, 5)
        place = sharding.walked(sharding.permuted(F.col("id"), n, 5), n, 5, steps)
        got = [r[0] for r in spark.range(n).select(place).collect()]
        assert sorted(got) == list(range(n))
        assert n < 50 or got != sorted(got)


@pytest.mark.parametrize("n,shards", [(0, 4), (1, 4), (50, 4), (101, 24)])
def test_shards_are_even_and_slots_gapless(spark, frame, n, shards):
    data = rows(n)
    got = sharding.assign_shards(frame(data, DOCS), shards).collect()
    assert len(got) == n
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        text = data[r.doc_id][2].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 8, zlib.crc32(text), "rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_with_nulls_repeats_and_long_texts(spark, frame):
    data = [(None, None, None)] * 3 + [(1, "a", "é")] * 20 + [(2, "a", "x" * 300_000), (3, None, "")]
    got = sharding.assign_shards(frame(data, "doc_id long, source string, text string"), 5).collect()
    assert len(got) == 25 and len({(r.shard, r.slot) for r in got}) == 25
    assert sum(r.doc_id is None and r.size == 8 and r.text_crc32 == 0 for r in got) == 3
    assert sum(r.doc_id == 1 and r.size == 10 for r in got) == 20


def hashed(*values):
    """xxhash64 over columns: each value's hash is the next one's seed; nulls leave it."""
    at = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v[0].to_bytes(4, "little") if isinstance(v, tuple) else v.to_bytes(8, "little")
            at = xxhash.xxh64_intdigest(data, at)
    return at - (1 << 64) if at >> 63 else at


@pytest.mark.parametrize("n,per_block", [(1, 50_000), (137, 50_000), (400, 60)])
def test_places_follow_the_permutation(spark, frame, monkeypatch, n, per_block):
    """Row numbers, permutation, walk, shard and slot reckoned again in plain Python."""
    monkeypatch.setattr(sharding, "NUMBERED_ROWS", per_block)
    data = [(None if i % 9 == 0 else i // 3, "s", "t" * (i % 5)) for i in range(n)]
    keys = [(i, len(t) + 8, zlib.crc32(t.encode())) for i, _, t in data]
    blocks, shards, seed = -(-n // per_block), 7, 7
    ordered = sorted(keys, key=lambda k: (hashed(*k) % blocks, k[0] is not None, k[0] or 0, k[1:]))
    a, b = sharding.grid(n)
    assert a * b >= n > a * b - a - b

    def place(row):
        while True:
            x, y = row % a, row // a
            for i in range(sharding.HALF_ROUNDS):
                m = b if i % 2 else a
                x, y = y, (x + hashed(y, (seed * sharding.HALF_ROUNDS + i,)) % m) % m
            row = x + y * a
            if row < n:
                return row

    want = Counter((*k, place(i) % shards, place(i) // shards) for i, k in enumerate(ordered))
    got = sharding.assign_shards(frame(data, "doc_id long, source string, text string"), shards, seed).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == want


def test_sharding_repeats(spark, frame):
    df = frame(rows(300), DOCS)
    assert sorted(sharding.assign_shards(df, 7).collect()) == sorted(sharding.assign_shards(df.repartition(5), 7).collect())


def water_filled(sizes, share=1.5, most=2):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if each * weight[s] >= most * sizes[s]}
        if not full:
            target.update({s: each * weight[s] for s in open_})
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_meets_targets(spark, frame):
    data = [(i, [None, "a", "b", "é", "z"][min(i % 11, 4)], "word " * (i * 7919 % 60)) for i in range(2500)]
    mixed = mixing.mix(frame(data, "doc_id long, source string, text string"))
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in mixed.collect():
        source = r.row.source
        assert r.mix.size == len((r.row.text or "").split()) and 0 <= r.mix.copies <= 2
        sizes[source] += r.mix.size
        taken[source] += r.mix.size * r.mix.copies
        targets[source] = r.mix.target
    want = water_filled(sizes)
    for s, t in want.items():
        assert abs(targets[s] - t) < 1e-6 * t and abs(taken[s] - t) <= 31
    again = mixing.mix(frame(data, "doc_id long, source string, text string").repartition(3))
    assert sorted((r.row.doc_id, r.mix.copies) for r in again.collect()) == sorted(
        (r.row.doc_id, r.mix.copies) for r in mixed.collect()
    )


def test_mix_zooms_into_ranks(spark, frame, monkeypatch):
    monkeypatch.setattr(mixing, "SORTED_ROWS", 5)
    monkeypatch.setattr(mixing, "SLICES", 4)
    data = [(i, "ab"[i % 4 == 0], "w " * (1 + i % 5)) for i in range(400)]
    mixed = mixing.mix(frame(data, "doc_id long, source string, text string")).collect()
    for source in "ab":
        part = [r.mix for r in mixed if r.row.source == source]
        assert abs(sum(m.size * m.copies for m in part) - part[0].target) <= 3


def test_pareto_draw_prefers_larger_inclusion(spark):
    from pyspark.sql import functions as F

    ids = spark.range(4000)
    ranks = ids.select(
        "id", mixing.rank(F.when(F.col("id") % 2 == 0, F.lit(0.8)).otherwise(F.lit(0.2)), 1, F.col("id")).alias("r")
    ).orderBy("r").limit(2000).collect()
    assert 0.75 < sum(r.id % 2 == 0 for r in ranks) / 2000 < 0.85  # Pareto sampling meets its inclusion odds


def test_larger_documents_are_included_more(spark, frame):
    """Inclusion grows with size, document by document, and the order follows it; the words still meet the target."""
    data = [(i, "a", "w " * (50 if i % 2 else 5)) for i in range(3000)]
    mixed = mixing.mix(frame(data, "doc_id long, source string, text string")).collect()
    more = lambda size: sum(r.mix.copies == 2 for r in mixed if r.mix.size == size) / 1500
    slope = 0.5 * 55 / (50 * 50 + 5 * 5)
    assert abs(more(50) - 50 * slope) < 0.05 and abs(more(5) - 5 * slope) < 0.03
    assert abs(sum(r.mix.copies * r.mix.size for r in mixed) - mixed[0].mix.target) <= 25


def test_null_and_repeated_ids_are_drawn_by_their_texts(spark, frame):
    data = [(None if i % 2 else 7, "a", f"w{i} " * 10) for i in range(1000)]
    mixed = mixing.mix(frame(data, "doc_id long, source string, text string")).collect()
    assert {r.mix.copies for r in mixed} == {1, 2} and abs(sum(r.mix.copies for r in mixed) - 1500) <= 1


@pytest.mark.parametrize("sorted_rows", [20_000, 7])
def test_draw_follows_the_ranks(spark, frame, monkeypatch, sorted_rows):
    """Inclusion, ranks, cut and copies reckoned again in plain Python, with null, repeated and equal rows."""
    monkeypatch.setattr(mixing, "SORTED_ROWS", sorted_rows)
    monkeypatch.setattr(mixing, "EQUAL_AT_ONCE", 5)
    data = [(None if i % 13 == 0 else i // 2, "abc"[i % 3 % 2], f"w{i % 4} " * (1 + i * 31 % 40)) for i in range(300)]
    data += [(7, "a", "same text here")] * 40 + [(None, "b", "x y")] * 11 + [(8, None, None)] * 3
    seed, size = 11, lambda t: len((t or "").split())
    sources = defaultdict(list)
    for i, s, t in data:
        sources[s].append((i, size(t), hashed(t)))
    target = water_filled({s: sum(r[1] for r in rows) for s, rows in sources.items()})
    want = Counter()
    for s, rows in sources.items():
        total = sum(r[1] for r in rows)
        whole = int(target[s] // total) if total else 0
        rest = target[s] - whole * total
        seen, ranked = Counter(), []
        for i, n, mark in rows:
            chance = min(1 - 1e-9, max(1e-9, rest / (sum(r[1] ** 2 for r in rows) or 1) * n))
            nth, seen[i, n, mark] = seen[i, n, mark], seen[i, n, mark] + 1
            u = (((hashed((seed,), i, n, mark & (1 << 64) - 1, nth) & (1 << 64) - 1) >> 12) + 0.5) * 2.0**-52
            ranked.append((math.log(u) - math.log1p(-u) - math.log(chance) + math.log1p(-chance), i, n))
        before = 0
        for _, i, n in sorted(ranked, key=lambda r: r[0]):
            more = 0 < rest < total and before + n / 2 <= rest
            want[i, s, n, whole + more] += 1
            before += n
    out = mixing.mix(frame(data, "doc_id long, source string, text string")).collect()
    assert Counter((r.row.doc_id, r.row.source, r.mix.size, r.mix.copies) for r in out) == want


def test_equal_rows_are_drawn_apart(spark, frame):
    data = [(5, "a", "one two three", n) for n in range(1001)]
    df = frame(data, "doc_id long, source string, text string, nth int")
    for part in (1, 6):
        mixed = mixing.mix(df.repartition(part)).collect()
        assert len({r.row.nth for r in mixed}) == 1001
        assert Counter(r.mix.copies for r in mixed) in (Counter({1: 501, 2: 500}), Counter({1: 500, 2: 501}))


def test_mix_edges(spark, frame):
    schema = "doc_id long, source string, text string, mix int, key string, plan int, `row` int"
    assert mixing.mix(frame([], schema)).collect() == []
    data = [(None, None, None, 1, "k", 2, 3)] * 2 + [(1, "a", "", 1, "k", 2, 3), (2, "a", "x " * 50_000, 1, "k", 2, 3)] * 2
    mixed = mixing.mix(frame(data, schema)).collect()
    assert len(mixed) == 6 and sum(m.mix.size * m.mix.copies for m in mixed) == 150_000  # equal rows are drawn apart
    out = mixing.mixture(frame(data, schema))
    assert out.columns == ["doc_id", "source", "text", "mix", "key", "plan", "row"]
    zero = mixing.mix(frame([(1, "a", " ", 1, "k", 2, 3)], schema)).collect()
    assert zero[0].mix.target == 0 and zero[0].mix.copies == 0
