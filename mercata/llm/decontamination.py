"""Benchmark decontamination by Wu-Manber search for many word windows at once.

The patterns are the windows of consecutive words of the benchmark's items; the symbols are words and a
block is two of them.  For each window length a shift table says how far the search may move on from a
block without missing a window, and a table of (last block, first block) tells which of the windows that
end in a block can lie here.  What passes both is compared, word for word, with the windows themselves.

Both tables are bounded in size and are all that travels to the tasks.  The windows stay a table: the
comparison is a join with the places that passed, so that neither the benchmark nor the hits of
any document pass through the driver, and a document without such a place is never shuffled with its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.support import stored

WINDOW = 10          # words
BLOCK = 2            # words
SHIFT_SLOTS = 1 << 22   # at most so many entries of one byte per window length
PREFIX_SLOTS = 1 << 26  # at most so many entries of one byte, kept as bits
LEAST_SLOTS = 1 << 12
PAGE = 1 << 16       # entries that one row of a table brings to the driver
ROWS_AT_ONCE = 20_000
SALTS = 16           # parts into which the places of a window that many documents share are dealt

#: What counts as a letter of a word: digits, a-z, every byte of a character beyond ASCII; A-Z become a-z.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(LETTERS).split() if text else []


def block_hash(words: list[bytes], at: int, start: int = 0) -> int:
    """Hash of the block of ``BLOCK`` words (or the single word) that ends in word ``at``."""
    return crc32(b" ".join(words[max(at - BLOCK + 1, 0):at + 1]), start)


def windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(n, window, items): every different window, its words joined by spaces, and the ids that hold it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item_id", pa.string()), ("n", pa.int32()), ("window", pa.string())])
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = words_of(text)
                n = min(window, len(words))
                for start in range(0, len(words) - n + 1 if n else 0, ROWS_AT_ONCE):
                    found = [b" ".join(words[i:i + n]) for i in range(start, min(start + ROWS_AT_ONCE, len(words) - n + 1))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(found), pa.string()), pa.array([n] * len(found), pa.int32()),
                         pa.array(found, pa.binary()).cast(pa.string())],
                        schema=schema,
                    )

    each = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    each = each.mapInArrow(cut, "item_id string, n int, window string")
    return each.groupBy("n", "window").agg(F.collect_set("item_id").alias("items"))


class Tables(NamedTuple):
    """The tables of one window length."""

    shift: np.ndarray   # by hash of a block: words that the search may move on
    prefix: np.ndarray  # bits by hash of last and first block: whether such a window exists


def slots(entries: int, per_entry: int, most: int) -> int:
    wanted = LEAST_SLOTS
    while wanted < min(entries * per_entry, most):
        wanted *= 2
    return wanted


def tables_of(patterns: DataFrame) -> dict[int, Tables]:
    """The tables by window length.  They are put together page by page in the tasks; a page has ``PAGE``
    entries, and what the driver gets is bounded by the numbers of slots, whatever the benchmark's size."""
    counts = {r["n"]: r["count"] for r in patterns.groupBy("n").count().collect()}  # at most WINDOW rows
    shift_slots = {n: slots(c * n, 8, SHIFT_SLOTS) for n, c in counts.items()}
    prefix_slots = {n: slots(c, 64, PREFIX_SLOTS) for n, c in counts.items()}
    kinds = pa.schema([("n", pa.int32()), ("kind", pa.int32()), ("slot", pa.int64()), ("value", pa.int32())])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[tuple[int, int, int], int] = {}
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                words = text.split(b" ")
                n, last = len(words), len(words) - 1
                first = min(BLOCK, n) - 1
                for at in range(first, n):
                    key = n, 0, block_hash(words, at) % shift_slots[n]
                    least[key] = min(least.get(key, n), last - at)
                least[n, 1, block_hash(words, first, block_hash(words, last)) % prefix_slots[n]] = 0
            rows = [(*key, value) for key, value in least.items()]
            for start in range(0, len(rows), ROWS_AT_ONCE):
                columns = zip(*rows[start:start + ROWS_AT_ONCE])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    def page(group: pa.Table) -> pa.Table:
        n, kind, number = (group.column(c)[0].as_py() for c in ("n", "kind", "page"))
        at = group.column("slot").to_numpy() - number * PAGE
        if kind:
            content = np.zeros(min(PAGE, prefix_slots[n]), bool)
            content[at] = True
            content = np.packbits(content)
        else:
            content = np.full(min(PAGE, shift_slots[n]), n - min(BLOCK, n) + 1, np.uint8)
            content[at] = group.column("value").to_numpy()
        return pa.table({"n": [n], "kind": [kind], "page": [number], "content": [content.tobytes()]}, schema=pages)

    pages = pa.schema([("n", pa.int32()), ("kind", pa.int32()), ("page", pa.int64()), ("content", pa.binary())])
    built = (
        patterns.select("window").mapInArrow(entries, "n int, kind int, slot long, value int")
        .groupBy("n", "kind", "slot").agg(F.min("value").alias("value"))
        .withColumn("page", F.floor(F.col("slot") / PAGE))
        .groupBy("n", "kind", "page").applyInArrow(page, "n int, kind int, page long, content binary")
    )
    out = {
        n: Tables(np.full(shift_slots[n], n - min(BLOCK, n) + 1, np.uint8), np.zeros(prefix_slots[n] // 8, np.uint8)) for n in counts
    }
    for row in built.toLocalIterator():
        content = np.frombuffer(bytes(row.content), np.uint8)
        start = row.page * (PAGE // 8 if row.kind else PAGE)
        out[row.n][row.kind][start:start + len(content)] = content
    return out


def places(words: list[bytes], n: int, shift: bytes, prefix: bytes) -> Iterator[int]:
    """Starts of the windows of ``n`` words that both tables let pass."""
    slots_, bits, first = len(shift) - 1, len(prefix) * 8 - 1, min(BLOCK, n) - 1
    at, end = n - 1, len(words)
    while at < end:
        last = crc32(words[at - 1] + b" " + words[at]) if first else crc32(words[at])
        step = shift[last & slots_]
        if step:
            at += step
            continue
        start = at - n + 1
        slot = block_hash(words[start:start + first + 1], first, last) & bits
        if prefix[slot >> 3] >> (7 - (slot & 7)) & 1:
            yield start
        at += 1


def searched(docs: DataFrame, tables: dict[int, Tables]) -> DataFrame:
    """One row (row, doc_id, n_words) per document and one (row, start, n, window) for each place that passed."""
    shared = docs.sparkSession.sparkContext.broadcast({n: (t.shift.tobytes(), t.prefix.tobytes()) for n, t in tables.items()})
    schema = "row long, doc_id long, n_words long, start long, n int, window string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [[], [], [], [], [], []]

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(found, kinds)]
            arrays[5] = arrays[5].cast(pa.string())
            for c in found:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_words", "start", "n", "window"])

        def add(*values) -> None:
            for c, v in zip(found, values):
                c.append(v)

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                words = words_of(text.as_py())
                add(row, doc_id, len(words), None, None, None)
                for n, (shift, prefix) in shared.value.items():
                    for start in places(words, n, shift, prefix):
                        add(row, None, None, start, n, b" ".join(words[start:start + n]))
                        if len(found[0]) >= ROWS_AT_ONCE:
                            yield batch_of()
            if found[0]:
                yield batch_of()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(scan, schema)


def covered(spans: Column) -> Column:
    """Words inside any of the (start, n) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))

    def add(state, span):
        end = F.greatest(state["end"], span["start"] + span["n"])
        return F.struct((state["hit"] + end - F.greatest(state["end"], F.least(span["start"], end))).alias("hit"), end.alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add)["hit"]


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words of each document that lie inside windows of the benchmark's items.

    Returns doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted ids, comma-joined),
    contaminated.  Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII.  An item's windows are its runs
    of ``window`` words; a shorter item is one window, one without words none.  Null and empty texts have no
    words; texts of any length are read whole; a document row is a result row, repeated and null ids included.
    An id that several benchmark rows share counts once; windows of an item without an id are hit, but
    the item is not counted.  An empty benchmark hits nothing, an empty table gives no rows; other columns are ignored.
    """
    patterns = stored(windows(benchmark, window), "decontamination-windows")
    tables = tables_of(patterns)
    scanned = stored(searched(docs, tables), "decontamination-places")
    passed = scanned.filter(F.col("start").isNotNull()).select("row", "start", "n", "window")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    occurring = patterns.join(passed.select("window").distinct(), "window", "left_semi")
    hits = (
        passed.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        .join(occurring.select("window", "items").withColumn("salt", every_salt), ["window", "salt"])
        .groupBy("row").agg(F.collect_set(F.struct("start", "n")).alias("spans"), F.collect_set("items").alias("items"))
        .withColumn("items", F.array_sort(F.array_distinct(F.flatten("items"))))
        .select(
            "row", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
    )
    none, no_items = F.lit(0).cast("long"), F.sha2(F.lit(""), 256)
    return (
        scanned.filter(F.col("start").isNull()).select("row", "doc_id", "n_words").join(hits, "row", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
            F.coalesce("items_sha256", no_items).alias("items_sha256"), (F.coalesce("n_hit", none) > 0).alias("contaminated"),
        )
    )


CONTAMINATED_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0))
), o AS (
  SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT row, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM t, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)
), h AS (SELECT o.row, o.i, o.n, p.item_id FROM o JOIN p ON o.win = p.win AND o.n = p.n),
k AS (SELECT row, count(DISTINCT at_word) AS n_hit FROM (SELECT row, unnest(generate_series(i, i + n - 1)) AS at_word FROM h) GROUP BY row),
m AS (
  SELECT row, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN k USING (row) LEFT JOIN m USING (row)
"""
