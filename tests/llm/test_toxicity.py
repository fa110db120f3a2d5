"""Toxicity: the field's marginals, learning, and the held-out fold."""

import itertools
import math
import random
import zlib

import numpy as np

from mercata.llm import toxicity

BAD = ["vilex", "grumf", "snarkle", "blorp"]
SCHEMA = "doc_id long, text string, score double, predicted int, draw int, toxic int"


def corpus(n, seed=1):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.choice('xyzuvw')}{rng.randrange(60)}" for _ in range(rng.randrange(10, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "ed", "!"]))
        texts.append("\n".join(" ".join(words[k:k + 12]) for k in range(0, len(words), 12)))
        labels.append(int(toxic))
    return texts, labels


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    moves = rng.normal(size=(2, 2))
    lengths = np.array([3, 1, 5, 2])
    scores = rng.normal(size=lengths.sum()) * 2
    got, at = toxicity.marginals(scores, lengths, moves), 0
    for n in lengths:
        total, on = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            weight = math.exp(sum(s for s, v in zip(scores[at:at + n], y) if v) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            total += weight
            on += weight * np.array(y)
        assert np.allclose(got[at:at + n], on / total)
        at += n


def test_learns_words_and_generalises():
    texts, labels = corpus(600)
    model = toxicity.fit(texts, labels)
    new, want = corpus(200, seed=2)
    scores, _, _ = toxicity.tagged(new, model)
    assert ((scores >= toxicity.THRESHOLD) == np.array(want, bool)).mean() > 0.97
    text = "ax1 by2 vilexing cz3\nblorp dx4"
    scores, p, _ = toxicity.tagged([text], model)
    found = [text[int(a):int(b)] for a, b in (s.split(":") for s in toxicity.spans(text, p).split(","))]
    assert found == ["vilexing", "blorp"]


def test_labels_of_one_kind_or_none():
    assert toxicity.tagged(["x", ""], toxicity.fit([], []))[0].max() < 0.01
    assert toxicity.tagged(["x"], toxicity.fit(["a b", "c"], [0, 0]))[0].max() < 0.01
    assert toxicity.tagged(["x"], toxicity.fit(["a b", "c"], [1, 1]))[0].min() > 0.9


def test_tables(spark, frame):
    texts, labels = corpus(400)
    rows = [(i, t, 0.0, 1, 2, 3) for i, t in enumerate(texts)]
    rows += [(None, texts[0], 0.0, 1, 2, 3), (1000, None, 0.0, 1, 2, 3), (1001, "", 0.0, 1, 2, 3), (1002, "a " * 200_000, 0.0, 1, 2, 3), (0, texts[0], 0.0, 1, 2, 3)]
    docs = frame(rows, SCHEMA)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    # labels of the held-out fold are wrong on purpose: they must not be learnt
    known = [(i, 0, (1 - y) if held(i) else y) for i, y in enumerate(labels)] + [(None, 0, 1), (7, 0, None), (5000, 0, 1)]
    model = toxicity.train(docs, frame(known, "doc_id long, quality int, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert np.mean([by[i].predicted == labels[i] for i in range(400)]) > 0.96
    assert by[1000].predicted == by[1001].predicted == by[1002].predicted == 0 and by[1000].score == by[1001].score
    assert by[None].score == by[0].score and by[0].spans
    kept = toxicity.score(docs, model, keep=True)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    flags = {r.doc_id: r.h for r in docs.select("doc_id", toxicity.held_out(docs.doc_id).alias("h")).collect()}
    assert all(flags[i] == held(i) for i in range(400)) and flags[None] is False
    empty = toxicity.train(frame([], SCHEMA), frame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score(frame([], SCHEMA), empty).collect() == []
