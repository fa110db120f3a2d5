"""The Merkle manifest against trees built in plain Python, and its SQL."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from mercata.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest int, key string, at int, row string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a - a % 8:a - a % 8 + 8]
            steps[i].append(("".join(run[:a % 8]), "".join(run[a % 8 + 1:])))
            at[i] = a // 8
        nodes = [digest("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], steps


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0], leaf(row, row[1]), row))
    langs = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = tree([x[1] for x in groups[lang]])
    root, above = tree([trees[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for lang, up in zip(langs, above):
        for (doc_id, name, row), steps in zip(groups[lang], trees[lang][1]):
            text = row[1]
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = text.translate(LOWER)
            fold = leaf(row, text)
            for before, behind in steps + up:
                fold = digest(before + fold + behind)
            proof = digest("".join(a + b for a, b in steps + up))
            out.append((doc_id, name, trees[lang][0], root, proof, fold, fold == root))
    return sorted(out, key=repr)


def made(sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7919 % 10007 - 300, f"Text {i} ÄÖ É", lang, f"s{i % 3}", i))
    return rows


def run(frame, rows):
    out = manifest.manifest(frame([(*r, 1, "k", 2, "r") for r in rows], SCHEMA))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 600, "de": 64, "fr": 65, "zz": 2, "ä": 1, "": 9, None: 8}, {f"l{i}": 1 + i % 3 for i in range(70)},
])
def test_trees_and_proofs(frame, sizes):
    rows = made(sizes)
    assert run(frame, rows) == brute(rows)


def test_nulls_repeats_and_long_texts(frame, monkeypatch):
    monkeypatch.setattr(manifest, "ROWS_PER_RANGE", 7)
    rows = made({"en": 40, "fr": 10})
    rows += [rows[3]] * 30 + [(5, "A", "en", None, None), (5, "B", "en", "s", 1), (5, None, None, None, None)]
    rows += [(None, "Q", "en", "s", 1), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(77, "Long Words " * 100_000, "en", "", 0), (78, "", "fr", "", 0)]
    assert run(frame, rows) == brute(rows)


def test_empty_table(frame):
    assert run(frame, []) == []


def test_a_changed_digest_changes_the_root(frame):
    rows = made({"en": 100, "de": 20})
    changed = [r if r[0] != rows[17][0] else (*r[:4], r[4] + 1) for r in rows]
    one, other = run(frame, rows), run(frame, changed)
    assert all(verified == (zlib.crc32(str(doc_id).encode()) % 3 != 0) for doc_id, *_, verified in one)
    assert one[0][3] != other[0][3] and len({r[2] for r in one} & {r[2] for r in other}) == 1


def test_sql_agrees(frame):
    rows = made({"en": 70, None: 9, "é": 1, "zh": 20}) + [(1, None, "en", None, None), (2, "X", None, "s", None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(manifest.manifest_sql()).fetchall(), key=repr) == brute(rows)
