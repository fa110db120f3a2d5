"""Wu-Manber search for benchmark windows against plain search, and its SQL."""

import hashlib
import random
import re

import duckdb
import pytest

from mercata.llm import decontamination

DOCS = "doc_id long, text string, row string, n int, window string, start int"
ITEMS = "item_id long, text string, n string, items int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    patterns = set()
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        patterns |= {(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1) if n}
    held = {}
    for item, p in patterns:
        held.setdefault(p, set()).add(item)
    lengths = {len(p) for p in held}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                ids = held.get(tuple(w[i:i + n]))
                if ids:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in ids if x is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def made():
    rng = random.Random(5)
    vocabulary = [a + b for a in ("ma", "no", "Ti", "é", "7") for b in ("ra", "lo", "Su", "ñ", "4")]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([1, 2, 3, 9, 10, 11, 40]))) for i in range(5, 30)]
    items += [(30, None), (31, ""), (32, "... !?"), (33, "Only-Once, here"), (34, "x y " * 30), (35, items[6][1] + "\nmore words")]
    items += [(None, "an item without an id, of more than ten words, yes it is"), (33, "only once  HERE"), (36, "loma" + " ra" * 9)]
    docs = [(i, text(rng.randint(1, 200))) for i in range(60)]
    for i in range(60, 100):
        a, b = rng.choice(items)[1] or "", rng.choice(items)[1] or ""
        docs.append((i, text(5) + "; " + a.upper() + "\t" + text(3) + "--" + b))
    docs += [(100, None), (101, ""), (102, "?!"), (103, "x y " * 40), (103, "x y " * 40), (None, "only once here"), (104, "ONLY  once"),
             (105, text(60_000) + " " + items[3][1]), (106, "an item without an id of more than ten words yes it is")]
    return docs, items


def run(frame, docs, items, **kwargs):
    out = decontamination.contaminated(
        frame([(*d, "r", 1, "w", 2) for d in docs], DOCS), frame([(*i, "n", 3) for i in items], ITEMS), **kwargs
    )
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("shift, prefix, window", [(1 << 22, 1 << 26, 10), (16, 16, 10), (1 << 10, 1 << 10, 4)])
def test_hits_as_plain_search_finds_them(frame, monkeypatch, shift, prefix, window):
    """Tables of any size: full ones let more places pass, and the comparison sorts them out."""
    monkeypatch.setattr(decontamination, "SHIFT_SLOTS", shift)
    monkeypatch.setattr(decontamination, "PREFIX_SLOTS", prefix)
    monkeypatch.setattr(decontamination, "LEAST_SLOTS", 16)
    monkeypatch.setattr(decontamination, "PAGE", 64)
    docs, items = made()
    assert run(frame, docs, items, window=window) == brute(docs, items, window)


def test_shifts_never_pass_a_window():
    rng = random.Random(3)
    for n in (1, 2, 3, 10):
        patterns = [[rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(n)] for _ in range(3)]
        shift, prefix = bytearray([n - min(2, n) + 1] * 64), bytes([255] * 8)
        for p in patterns:
            for at in range(min(2, n) - 1, n):
                slot = decontamination.block_hash(p, at) % 64
                shift[slot] = min(shift[slot], n - 1 - at)
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(3000)]
        there = {i for i in range(len(text) - n + 1) if text[i:i + n] in patterns}
        assert there <= set(decontamination.places(text, n, bytes(shift), prefix))


def test_clean_text_is_skipped():
    """Most words of a text that shares no block with the windows are never looked at."""
    shift, seen = bytes([9] * 64), []

    class Watched(list):
        def __getitem__(self, i):
            seen.append(i)
            return super().__getitem__(i)

    assert not list(decontamination.places(Watched([b"w"] * 900), 10, shift, bytes(8)))
    assert len(seen) <= 2 * 900 / 9 + 2


def test_empty_tables(frame):
    docs, items = made()
    assert run(frame, [], items[:2]) == []
    assert run(frame, docs[:3] + [(None, None)], []) == brute(docs[:3] + [(None, None)], [])


def test_sql_agrees():
    docs, items = made()
    docs = [d for d in docs if d[0] != 105]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.execute(decontamination.CONTAMINATED_SQL).fetchall(), key=repr) == brute(docs, items)
