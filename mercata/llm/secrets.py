"""Secret scan: fixed patterns plus a token-efficiency test.

A vocabulary learnt from text spells words with long tokens and random strings with short
ones.  Runs of key characters that need many tokens for their length are reported, unless
they have the form of a known digest or identifier; runs without a digit need more still.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LONGEST_RATIO = 2.0   # characters per token of a random string, at most
LETTERS_RATIO = 1.8   # the same of a string without digits
SHORTEST = 20         # characters of a string that is tested
LONGEST = 512         # longer runs are encoded data, judged piece by piece

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
KINDS = ("assign", "access", "hex", "random")
#: Digests in hexadecimal (MD5, SHA-1, SHA-224/256/384/512) and UUIDs.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.IGNORECASE)
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
DIGITS = re.compile(r"[0-9_+/=-]+")  # numbers, dates, rules of a page
SPLIT = r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+"


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def identifier(run: str) -> bool:
    """Known digests, UUIDs and numbers."""
    return bool(DIGEST.fullmatch(run) or UUID.fullmatch(run) or DIGITS.fullmatch(run))


def uncovered(start: int, end: int, base: list) -> Iterator[tuple[int, int]]:
    """What the base spans, sorted by start, leave of a run."""
    for b_start, _, b_end in base:
        if b_start >= end:
            break
        if b_end > start:
            if b_start > start:
                yield start, b_start
            start = b_end
    if start < end:
        yield start, end


def pieces(start: int, end: int) -> Iterator[tuple[int, int]]:
    """A run in pieces of ``LONGEST`` characters; a last one too short to be tested goes with the one before."""
    while start < end:
        stop = start + LONGEST if end - start >= LONGEST + SHORTEST else end
        yield start, stop
        start = stop


def random_runs(text: str, path: str, base: list) -> Iterator[tuple[int, int]]:
    """Random pieces of what the base spans leave of each run."""
    for run in RUN.finditer(text):
        if identifier(run.group()):
            continue
        for start, end in uncovered(run.start(), run.end(), base):
            rest = text[start:end]
            if len(rest) < SHORTEST or identifier(rest):
                continue
            ratio = LONGEST_RATIO if any(c.isdigit() for c in rest) else LETTERS_RATIO
            for at, stop in pieces(start, end):
                if stop - at <= ratio * len(encoding(path).encode_ordinary(text[at:stop])):
                    yield at, stop


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' matches."""
    found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    folded = text.lower()
    if any(word in folded for word in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    return sorted(found)


def spans(text: str, path: str = VOCABULARY) -> tuple[list, list]:
    """Base spans and all spans of a text, by start, then kind as listed.  A random run is what
    the base spans leave of it."""
    base = base_spans(text)
    return base, sorted(base + [(start, 3, end) for start, end in random_runs(text, path, base)])


def written(found: list) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Spans of secrets in every whole text of ``docs`` (doc_id, text).

    Returns doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans; positions are code
    points, ends exclusive.  A null text counts as empty and has no spans; rows with equal or
    null ids are scanned one by one; other columns are ignored; an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, every = spans(text or "", vocabulary)
                counts = [sum(1 for _, k, _ in every if k == kind) for kind in range(4)]
                rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    )


def redacted(text: str | None, mark: str, vocabulary: str = VOCABULARY) -> str | None:
    """The text with every span replaced by ``mark``; overlapping spans are one."""
    if not text:
        return text
    out, at = [], 0
    for start, _, end in spans(text, vocabulary)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, mark: str = "<secret>", vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows and columns of ``docs`` with secrets in ``text`` replaced by ``mark``; ``n_chars``,
    where present, is counted anew for changed texts.  Nulls and texts without secrets stay."""
    names = docs.columns
    place, counted = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in batches:
            old = batch.column(place).to_pylist()
            new = [redacted(text, mark, vocabulary) for text in old]
            columns = list(batch.columns)
            columns[place] = pa.array(new, columns[place].type)
            if counted is not None:
                was = batch.column(counted)
                columns[counted] = pa.array(
                    [n if a == b else len(b) for a, b, n in zip(old, new, was.to_pylist())], was.type
                )
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
