"""Best-fit packing of documents into sequences, under conflicts.

Documents longer than a sequence fill whole sequences first; what is left is packed by
best fit in order of falling size.  A bin carries a bitmap of the sources and one of the
duplicate clusters it holds.  The search starts at the smallest residual that fits and goes on to
the next larger one until a bin without a conflict is found: the tightest compatible bin.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.mixing import words
from mercata.llm.support import blocks_of, hashed_block, stored

CAPACITY = 1_024        # words of a sequence
PACKED_ROWS = 20_000    # documents packed by one task
TRACKED_SOURCES = 48    # most frequent sources of a group for which open residuals are kept


class Bins:
    """Bins by residual, with the residuals at which a bin lacks a given source."""

    def __init__(self, capacity: int, tracked: list[int]):
        self.capacity = capacity
        self.levels: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.filled = 0                                   # bit r: some bin has residual r
        self.tracked = tracked
        self.lacking = {s: [0] * (capacity + 1) for s in tracked}
        self.open = dict.fromkeys(tracked, 0)             # bit r: some bin with residual r lacks the source
        self.residual: list[int] = []
        self.sources: list[int] = []                      # bitmaps
        self.clusters: list[int] = []

    def _count(self, bin_: int, level: int, step: int) -> None:
        held, bit = self.sources[bin_], 1 << level
        for s in self.tracked:
            if not held >> s & 1:
                row = self.lacking[s]
                row[level] += step
                if row[level]:
                    self.open[s] |= bit
                else:
                    self.open[s] &= ~bit

    def _leave(self, bin_: int) -> None:
        level = self.residual[bin_]
        self.levels[level].remove(bin_)
        if not self.levels[level]:
            self.filled &= ~(1 << level)
        self._count(bin_, level, -1)

    def _enter(self, bin_: int) -> None:
        level = self.residual[bin_]
        if level:
            self.levels[level].append(bin_)
            self.filled |= 1 << level
            self._count(bin_, level, 1)

    def find(self, size: int, source: int, cluster: int) -> int | None:
        """The fullest bin that fits and conflicts in neither source nor cluster (0: no cluster)."""
        ahead = self.open.get(source, self.filled) >> size
        level = size - 1
        while ahead:
            skip = (ahead & -ahead).bit_length()
            level += skip
            ahead >>= skip
            for bin_ in self.levels[level]:
                if not self.sources[bin_] >> source & 1 and not self.clusters[bin_] & cluster:
                    return bin_
        return None

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Place a piece; returns its bin and offset."""
        bin_ = self.find(size, source, cluster)
        if bin_ is None:
            bin_ = len(self.residual)
            self.residual.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
        else:
            self._leave(bin_)
        offset = self.capacity - self.residual[bin_]
        self.residual[bin_] -= size
        self.sources[bin_] |= 1 << source
        self.clusters[bin_] |= cluster
        self._enter(bin_)
        return bin_, offset


def packed(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of every piece (each of 1 to ``capacity`` words), in the given order of rows."""
    ranked = [s for s, _ in Counter(sources).most_common()]
    number = {s: i for i, s in enumerate(ranked)}
    shared = [c for c, n in Counter(clusters).items() if n > 1]
    bit = {c: 1 << i for i, c in enumerate(shared)}
    bins = Bins(capacity, list(range(min(TRACKED_SOURCES, len(ranked)))))
    out: list = [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = bins.put(sizes[i], number[sources[i]], bit.get(clusters[i], 0))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None) -> DataFrame:
    """Sequences of ``docs`` (doc_id, source, text): one row per piece of a document.

    Returns doc_id, source, size (words of the document), piece, n_words, sequence, offset, fill (words in the
    piece's sequence).  No sequence holds two documents of one source, nor two of one duplicate cluster (by default
    equal texts; null texts are no copies of each other).  A document without words has one row with no sequence.
    A null source is a source of its own; repeated rows are packed apart, being copies.  Groups of documents
    are packed independently, dealt by hash of id, text and the number of a copy.  An empty table gives no rows; other columns are ignored.
    """
    each = stored(docs.select(
        "doc_id", "source", words(F.col("text")).alias("size"),
        (F.xxhash64("text") if cluster is None else cluster).alias("cluster"),
    ), "pack-rows")
    groups = blocks_of(each.count(), PACKED_ROWS)
    rest = F.col("size") % capacity
    whole = F.col("size") - rest
    key = ["doc_id", "source", "size", "cluster"]  # rows that agree in these are numbered as copies
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    whole_pieces = (
        each.filter(whole > 0).groupBy(*key).count().select(*key, upto(F.col("count")).alias("copy"))
        .select(*key, "copy", upto(F.floor(whole / capacity)).alias("piece"))
    ).select(
        "doc_id", "source", "size", "piece", F.lit(capacity).cast("long").alias("n_words"),
        F.concat_ws(
            "-", F.lit("whole"), F.hex(F.xxhash64("doc_id", "cluster")), F.hex(F.xxhash64("source", "size")),
            F.col("doc_id"), F.col("piece"), F.col("copy"),
        ).alias("sequence"),
        F.lit(0).cast("long").alias("offset"), F.lit(capacity).cast("long").alias("fill"),
    )
    empty = each.filter("size = 0").select(
        "doc_id", "source", "size", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("string").alias("sequence"), F.lit(None).cast("long").alias("offset"), F.lit(None).cast("long").alias("fill"),
    )
    copies = each.filter(rest > 0).groupBy(*key).count().select(*key, upto(F.col("count")).alias("copy"))
    left = copies.select(
        "doc_id", "source", "size", F.floor(whole / capacity).alias("piece"), rest.alias("n_words"), "cluster",
        hashed_block(groups, F.lit(5), F.col("doc_id"), F.col("cluster"), F.col("copy")).alias("group"),
    ).repartitionByRange(groups, "group")  # by number, so that no two groups share a task
    types = pa.schema([("sequence", pa.string()), ("offset", pa.int64()), ("fill", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("cluster", "ascending"), ("source", "ascending")])
        sizes = rows.column("n_words").to_pylist()
        places = packed(sizes, rows.column("source").to_pylist(), rows.column("cluster").to_pylist(), capacity)
        fill = Counter()
        for (bin_, _), size in zip(places, sizes):
            fill[bin_] += size
        name = f"{rows.column('group')[0].as_py()}-"
        out = rows.select(["doc_id", "source", "size", "piece", "n_words"])
        for field, values in zip(types, ([f"{name}{b}" for b, _ in places], [o for _, o in places], [fill[b] for b, _ in places])):
            out = out.append_column(field, pa.array(values, field.type))
        return out

    kinds = {n: docs.schema[n].dataType.simpleString() for n in ("doc_id", "source")}
    schema = (
        f"doc_id {kinds['doc_id']}, source {kinds['source']}, size long, piece long, n_words long, "
        "sequence string, offset long, fill long"
    )
    return left.groupBy("group").applyInArrow(run, schema).unionByName(whole_pieces).unionByName(empty)
