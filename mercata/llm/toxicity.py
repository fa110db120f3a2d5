"""Toxicity by a linear-chain conditional random field over the words of a line.

Only documents are labelled, so tokens get their training labels from the sampled documents:
a word of a toxic document is labelled toxic when it, or its beginning, occurs far more often
in toxic documents than in clean ones.  The field's forward-backward marginals tag words; a
document's score is a logistic function of its marginals, fitted on sampled documents that the
field has not seen.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.llm.support import stored, uniform

SAMPLE_PER_CLASS = 1_500    # labelled rows of each class that the model is fitted on, at most
SAMPLE_TOKENS = 600_000     # tokens of the sampled rows' lines that the field is trained on, at most
SAMPLE_CHARS = 48_000_000   # characters of the sampled rows, at most (rows in order of their draw)
STEPS = 60
TIMES = 4                   # how much more often a telling word occurs in toxic documents
SURPRISE = 20.0             # its likelihood-ratio statistic, at least
THRESHOLD = 0.3
TAGGED = 0.5                # marginal from which a word is reported as offending
ENDS = ".,;:!?\"'()[]{}<>*#%&$|=~`_-"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEMPLATES = ("word", "p3", "p4", "p5", "p6", "p7", "s3")
MARKING = 6                 # templates (all but the suffix) whose telling features label tokens


def features(word: str) -> tuple[str, ...]:
    """One feature per template; a word shorter than a template has none there."""
    n = len(word)
    return (word, *(word[:k] if n > k else "" for k in (3, 4, 5, 6, 7)), word[-3:] if n > 3 else "")


def plain(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(ENDS)


def lines_of(text: str | None) -> list[list[bytes]]:
    """The words of every line that has any.  Bytes split at ASCII white space alone."""
    return [words for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if (words := line.split())]


# ---- the field ----------------------------------------------------------------
def ratios(odds: np.ndarray, lengths: np.ndarray, moves: np.ndarray):
    """Forward and backward ratios (label 1 over label 0) of tokens laid out line after line.
    Lines are stepped through side by side, longest first."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    first, long = starts[order], lengths[order]
    forward, backward = odds.copy(), np.ones_like(odds)
    alive = np.searchsorted(-long, -np.arange(1, long[0] + 1) + 0.5) if len(long) else []
    (t00, t01), (t10, t11) = moves
    for t in range(1, len(alive)):
        at = first[:alive[t]] + t
        r = forward[at - 1]
        forward[at] = odds[at] * (t01 + r * t11) / (t00 + r * t10)
    for t in range(len(alive) - 1, 0, -1):
        at = first[:alive[t]] + t
        w = odds[at] * backward[at]
        backward[at - 1] = (t10 + t11 * w) / (t00 + t01 * w)
    return forward, backward


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    forward, backward = ratios(np.exp(np.clip(scores, -30, 30)), lengths, np.exp(moves))
    both = forward * backward
    return both / (1 + both)


@dataclass
class Model:
    """Weights of the field and of the document score."""

    weights: list[dict] = field(default_factory=lambda: [{} for _ in TEMPLATES])
    bias: float = -10.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: tuple = (-6.0, 0.0, 0.0, 0.0)

    def word(self, word: bytes) -> float:
        return self.bias + sum(w.get(f, 0.0) for w, f in zip(self.weights, features(plain(word))))


class Scores(dict):
    """Word scores of one task, kept while there are not too many."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: bytes) -> float:
        if len(self) > 500_000:
            self.clear()
        got = self[word] = self.model.word(word)
        return got


def summary(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of the documents that begin at ``first``: log-odds of the highest marginal, logs of the marginals'
    sum and of their share of the words."""
    top = np.clip(np.maximum.reduceat(p, first), 1e-9, 1 - 1e-6)
    total = np.add.reduceat(p, first) + 1e-3
    words = np.diff(np.append(first, len(p))) + 20.0
    return np.stack([np.log(top) - np.log1p(-top), np.log(total), np.log(total / words)], axis=1)


#: What a text without words counts as: no marginal at all.
WORDLESS = (math.log(1e-9), math.log(1e-3), math.log(1e-3 / 20.0))


def chance(logit):
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def tagged(texts: list, model: Model, known: Scores | None = None):
    """Score of every text, and the marginals of its words."""
    known = known if known is not None else Scores(model)
    docs = [lines_of(text) for text in texts]
    counts = [sum(map(len, lines)) for lines in docs]
    total = sum(counts)
    base = chance(np.array([1.0, *WORDLESS]) @ model.document)
    scores = np.full(len(texts), base)
    p = np.zeros(0)
    if total:
        emitted = np.fromiter((known[w] for lines in docs for words in lines for w in words), float, total)
        lengths = np.fromiter((len(words) for lines in docs for words in lines), np.int64)
        p = marginals(emitted, lengths, model.moves)
        has = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[has].astype(np.int64)
        scores[has] = chance(np.hstack([np.ones((len(has), 1)), summary(p, starts)]) @ model.document)
    return scores, p, counts


def spans(text: str, p: np.ndarray) -> str:
    """Code-point offsets of runs of tagged words, as start:end joined by commas."""
    hot = np.flatnonzero(p >= TAGGED)
    if not len(hot):
        return ""
    wanted, out, last = set(hot.tolist()), [], None
    for i, m in enumerate(WORD.finditer(text)):
        if i in wanted:
            if last == i - 1 and "\n" not in text[out[-1][1]:m.start()]:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            last = i
    return ",".join(f"{a}:{b}" for a, b in out)


# ---- fitting ------------------------------------------------------------------
def key(text: str) -> bytes:
    """Smallest hash of a document's runs of five words: near copies mostly share it."""
    words = text.lower().split()
    runs = {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
    return min(hashlib.blake2b(r.encode("utf-8", "surrogatepass"), digest_size=8).digest() for r in runs)


def surprise(n: int, m: int, n1: int, n0: int) -> float:
    """Likelihood-ratio statistic of a feature in n of n1 toxic and m of n0 clean documents."""
    def part(seen, expected):
        return seen * math.log(seen / expected) if seen else 0.0

    rate = (n + m) / (n1 + n0)
    return 2 * (
        part(n, n1 * rate) + part(m, n0 * rate)
        + part(n1 - n, n1 * (1 - rate) or 1) + part(n0 - m, n0 * (1 - rate) or 1)
    )


def telling(docs: list, labels: np.ndarray) -> list[set]:
    """Per template but suffixes, the features that occur far more often in toxic documents."""
    n1, n0 = max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
    out = []
    for template in range(MARKING):
        in1, in0 = {}, {}
        for words, label in zip(docs, labels):
            for f in {features(w)[template] for w in words} - {""}:
                side = in1 if label else in0
                side[f] = side.get(f, 0) + 1
        out.append({
            f for f, n in in1.items()
            if n / n1 >= TIMES * ((m := in0.get(f, 0)) + 0.5) / n0 and surprise(n, m, n1, n0) >= SURPRISE
        })
    return out


def fit(texts: list[str], labels: list[int], steps: int = STEPS) -> Model:
    """The model of a bounded sample of labelled documents (one of each group of near copies)."""
    seen, kept = set(), []
    for i, text in enumerate(texts):
        if text and WORD.search(text) and (k := key(text)) not in seen:
            seen.add(k)
            kept.append(i)
    labels = np.array([labels[i] for i in kept], dtype=float)
    if not len(kept) or labels.min() == labels.max():
        always = 6.0 if len(kept) and labels.min() == 1 else -6.0
        return Model(document=(always, 0.0, 0.0, 0.0))
    lines = [[[plain(w) for w in words] for words in lines_of(texts[i])] for i in kept]
    train = np.arange(len(kept)) % 4 != 3  # the others fit the document score
    if labels[train].min() == labels[train].max() or labels[~train].size < 8 or labels[~train].min() == labels[~train].max():
        train = np.ones(len(kept), bool)
    words_of = [{w for words in doc for w in words} for doc in lines]
    marks = telling([w for w, t in zip(words_of, train) if t], labels[train])

    def toxic(word: str) -> bool:
        return any(f in m for f, m in zip(features(word), marks))

    chosen, size = [], 0
    for i in np.flatnonzero(train):
        for words in lines[i]:
            if size + len(words) <= SAMPLE_TOKENS:
                chosen.append((words, labels[i]))
                size += len(words)
    types = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in chosen for w in words))}
    token = np.array([types[w] for words, _ in chosen for w in words])
    lengths = np.array([len(words) for words, _ in chosen])
    marked = np.array([toxic(w) for w in types], float)
    y = marked[token] * np.repeat([label for _, label in chosen], lengths)
    names, index = [{} for _ in TEMPLATES], np.zeros((len(types), len(TEMPLATES)), np.int64)
    total = 1  # weight 0 belongs to missing features
    for row, word in enumerate(types):
        for t, f in enumerate(features(word)):
            if f:
                if f not in names[t]:
                    names[t][f] = total
                    total += 1
                index[row, t] = names[t][f]
    weights, bias, moves = trained(token, lengths, y, index, total, steps)
    model = Model(
        [{f: float(weights[i]) for f, i in names[t].items() if abs(weights[i]) > 0.02} for t in range(len(TEMPLATES))],
        bias, moves,
    )
    judged = np.flatnonzero(~train) if not train.all() else np.arange(len(kept))
    _, p, counts = tagged([texts[kept[i]] for i in judged], model)
    s = summary(p, np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64))
    model.document = logistic(s, labels[judged])
    return model


def trained(token, lengths, y, index, total, steps):
    """Weights, bias and moves that maximise the likelihood of the token labels (Adam, whole batch)."""
    n = len(token)
    rate = min(max(y.mean(), 1e-4), 0.5)
    params = np.zeros(total + 1 + 4)
    params[total] = math.log(rate / (1 - rate))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    ends = np.cumsum(lengths) - 1
    inner = np.ones(n, bool)
    inner[ends] = False
    left = np.flatnonzero(inner)
    seen = np.stack([
        (y[left] == a) & (y[left + 1] == b) for a in (0, 1) for b in (0, 1)
    ]).sum(axis=1).astype(float) if len(left) else np.zeros(4)
    flat = index.ravel()
    for step in range(1, steps + 1):
        params[0] = 0.0
        moves = params[total + 1:].reshape(2, 2)
        e = params[index].sum(axis=1) + params[total]
        odds = np.exp(np.clip(e[token], -30, 30))
        potentials = np.exp(moves)
        forward, backward = ratios(odds, lengths, potentials)
        both = forward * backward
        p = both / (1 + both)
        per_type = np.bincount(token, weights=p - y, minlength=len(index))
        grad = np.zeros_like(params)
        grad[:total] = np.bincount(flat, weights=np.repeat(per_type, index.shape[1]), minlength=total)
        grad[total] = per_type.sum()
        if len(left):
            r, w = forward[left], odds[left + 1] * backward[left + 1]
            pairs = np.stack([
                np.full(len(left), potentials[0, 0]), potentials[0, 1] * w, potentials[1, 0] * r, potentials[1, 1] * r * w
            ])
            grad[total + 1:] = (pairs / pairs.sum(axis=0)).sum(axis=1) - seen
        grad[:total] += 0.5 * params[:total]
        grad[total + 1:] += 5 * params[total + 1:]
        grad /= n
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        params -= 0.25 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    params[0] = 0.0
    return params[:total], float(params[total]), params[total + 1:].reshape(2, 2).copy()


def logistic(x: np.ndarray, y: np.ndarray) -> tuple:
    """Intercept and weights of a ridge logistic regression, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    ridge = np.diag([1e-3] + [0.02] * (x.shape[1] - 1)) * max(1.0, len(x) / 100)
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step * min(1.0, 4 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


# ---- on tables ----------------------------------------------------------------
def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, seed: int = 3) -> DataFrame:
    """Labelled documents outside the held-out fold, (draw, doc_id, text, toxic): up to ``SAMPLE_PER_CLASS`` of each class
    and ``SAMPLE_CHARS`` characters together, drawn by hash of doc_id.

    Null ids and null labels take no part; of several labels of an id the highest counts, of several rows the shortest; a
    document of more than a hundredth of ``SAMPLE_CHARS`` is not drawn.  The sample is cut before any text is brought to the training task, so long or repeated rows don't add to it."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("draw", uniform(seed, F.col("doc_id")))
    )
    of = lambda one: known.filter((F.col("toxic") > 0) == one).orderBy("draw", "doc_id").limit(SAMPLE_PER_CLASS)
    chosen = stored(of(True).unionByName(of(False)), "toxic-sample")
    text = F.coalesce(F.col("text"), F.lit(""))
    # 2 * SAMPLE_PER_CLASS ids at most; one row of each
    each = docs.select("doc_id", F.length(text).alias("size"), F.xxhash64(text).alias("print")).join(F.broadcast(chosen), "doc_id")
    each = each.filter(F.col("size") * 100 <= SAMPLE_CHARS).groupBy("draw", "doc_id", "toxic").agg(F.min(F.struct("size", "print")).alias("row"))
    so_far = F.sum("row.size").over(Window.orderBy("draw", "doc_id"))
    kept = stored(each.withColumn("so_far", so_far).filter(F.col("so_far") <= SAMPLE_CHARS).select("draw", "doc_id", "toxic", "row.*"), "toxic-kept")
    found = docs.select("doc_id", text.alias("text")).join(F.broadcast(kept), "doc_id")
    same = (F.length("text") == F.col("size")) & (F.xxhash64("text") == F.col("print"))
    return found.filter(same).groupBy("draw", "doc_id", "toxic").agg(F.first("text").alias("text")).select("draw", "doc_id", "text", "toxic")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit the model in one task on the bounded sample; only its weights come back."""
    import pickle

    def run(batches):
        rows = sorted(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("draw", "doc_id", "text", "toxic"))))
        fitted = fit([text for _, _, text, _ in rows], [int(toxic > 0) for *_, toxic in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted)], pa.binary())], names=["model"])

    model = stored(sampled(docs, labels).repartition(1).mapInArrow(run, "model binary"), "toxic-model")
    found = model.first()  # no partition, and so no row, without labelled documents
    return pickle.loads(found["model"]) if found else fit([], [])


def score(docs: DataFrame, model: Model, keep: bool = False) -> DataFrame:
    """Score every whole text: doc_id, score, predicted, n_tagged, spans (offsets of tagged words).

    With ``keep``, the rows and columns of ``docs`` whose documents are not predicted toxic instead.  A null or
    empty text is scored like one without any word; rows with equal or null ids are scored one by one; very long texts are
    scored whole.  An empty table gives no rows; without ``keep`` other columns are ignored."""
    def scored(batches):
        known = Scores(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got, p, counts = tagged(texts, model, known)
            yield batch, texts, got, p, counts

    def run(batches):
        for batch, texts, got, p, counts in scored(batches):
            at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            places = [spans(t or "", p[a:b]) for t, a, b in zip(texts, at, at[1:])]
            tags = [int((p[a:b] >= TAGGED).sum()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(got), pa.array(got >= THRESHOLD).cast(pa.int32()), pa.array(tags, pa.int64()),
                 pa.array(places, pa.string())],
                names=["doc_id", "score", "predicted", "n_tagged", "spans"],
            )

    def clean(batches):
        for batch, _, got, _, _ in scored(batches):
            yield batch.filter(pa.array(got < THRESHOLD))

    if keep:
        return docs.mapInArrow(clean, docs.schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, n_tagged long, spans string"
    )
