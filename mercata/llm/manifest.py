"""A Merkle manifest of a table: digests that name it as a whole, and a proof for every row.

Each level of the tree is a table of (key, at, total, digest): node ``at`` of the ``total`` nodes of
a tree.  Windows over spans of whole runs supply every node's siblings by lag and lead at
fixed offsets, masked by the node's slot in its run and by the run's length; the first child of
a run hashes the parent.  A level has an eighth of the rows of the one below, so all levels together
cost little more than the leaves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercata.llm.support import blocks_of, stored

FANOUT = 8
SPAN = FANOUT**4         # nodes of one window: whole runs, a bounded number
ROWS_PER_RANGE = 50_000  # rows that one task sorts
PARTITION_BITS = 33      # monotonically_increasing_id: partition number above these bits
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEPS = "array<struct<before:string,behind:string>>"


def leaf(*values: Column) -> Column:
    """Digest of a row: each value as byte count, colon and value, or ``-`` for null."""
    text = [v.cast("string") for v in values]
    sized = [F.concat(F.octet_length(v).cast("string"), F.lit(":"), v) for v in text]
    return F.sha2(F.concat(*[F.coalesce(v, F.lit("-")) for v in sized]), 256)


def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``at``, the place of a row among those of its key, and ``total``, their number.

    Rows are sorted in ranges of all keys together, so a large key is spread over many tasks;
    what is added up per key is one number per range.  ``order`` must tell all rows of a key apart.
    """
    ranges = blocks_of(rows.count(), ROWS_PER_RANGE)
    by = [F.col(c).asc_nulls_first() for c in [key, *order]]
    ordered = rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    ordered = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "manifest-order")
    ordered = ordered.withColumn("range", F.shiftright("place", PARTITION_BITS))
    runs = ordered.groupBy(key, "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(key)
    runs = runs.select(
        key, "range", "first", F.sum("n").over(whole).alias("total"),
        (F.sum("n").over(whole.orderBy("range")) - F.col("n")).alias("before"),
    )
    return ordered.join(runs, [key, "range"]).withColumn(
        "at", F.col("before") + F.col("place") - F.col("first")
    ).drop("range", "first", "before", "place")


def beside(nodes: DataFrame) -> DataFrame:
    """Add the digests of a node's siblings before and behind it in its run, joined."""
    span = Window.partitionBy("key", F.floor(F.col("at") / SPAN)).orderBy("at")
    slot = F.col("at") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("total") - F.col("at") + slot)
    before = [F.when(slot >= k, F.lag("digest", k).over(span)) for k in range(FANOUT - 1, 0, -1)]
    behind = [F.when(slot + k < length, F.lead("digest", k).over(span)) for k in range(1, FANOUT)]
    return nodes.withColumns({"before": F.concat_ws("", *before), "behind": F.concat_ws("", *behind)})


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: one node for each run of the trees that still have several nodes."""
    firsts = nodes.filter((F.col("total") > 1) & (F.col("at") % FANOUT == 0))
    return firsts.select(
        "key", F.floor(F.col("at") / FANOUT).alias("at"), F.ceil(F.col("total") / FANOUT).alias("total"),
        F.sha2(F.concat("digest", "behind"), 256).alias("digest"),
    )


def levels_of(leaves: DataFrame) -> list[DataFrame]:
    """The written levels of all trees, leaves first; a node with ``total`` 1 is the top of its tree."""
    levels = [stored(beside(leaves), "manifest-level")]
    most = levels[0].agg(F.max("total")).first()[0] or 0
    while most > 1:
        levels.append(stored(beside(parents(levels[-1])), "manifest-level"))
        most = -(-most // FANOUT)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [x.filter("total = 1").select("key", "digest") for x in levels])


def proofs(levels: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """The leaves with ``top`` and ``steps``: per level up to the top the siblings before and behind,
    then the steps that ``above`` (key, steps) has for the tree, if any."""
    known = None
    for nodes in reversed(levels):
        kept = [c for c in nodes.columns if c not in ("before", "behind")]
        tops_here = nodes.filter("total = 1")
        tops_here = tops_here.withColumn("steps", F.array().cast(STEPS)) if above is None else tops_here.join(above, "key")
        known_here = tops_here.select(*kept, F.col("digest").alias("top"), "steps")
        if known is not None:
            upper = known.select("key", F.col("at").alias("parent"), "top", "steps")
            inner = nodes.filter("total > 1").withColumn("parent", F.floor(F.col("at") / FANOUT))
            here = F.array(F.struct("before", "behind")).cast(STEPS)
            inner = inner.join(upper, ["key", "parent"]).select(*kept, "top", F.concat(here, "steps").alias("steps"))
            known_here = known_here.unionByName(inner)
        known = known_here
    return known


def folded(digest: Column, steps: Column) -> Column:
    """The root that a leaf's digest and its steps lead to."""
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["behind"]), 256))


def tampered(docs: DataFrame) -> Column:
    """The trial of the proofs: rows whose decimal doc_id has a crc32 divisible by 3 get their text in lower case."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return F.when(chosen, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def manifest(docs: DataFrame, trial=tampered) -> DataFrame:
    """Leaf digest, tree and proof of every row, and whether the row as ``trial`` leaves its text still proves.

    Returns doc_id, leaf, subroot (of the row's lang), root, proof_sha256 (digest of all siblings up to the
    root), folded_root, verified.  Trees are per lang, the leaves in order of doc_id, null first, equal ids by
    leaf digest; equal rows take neighbouring places.  A null in any field is ``-`` in its leaf; a null
    lang is a tree of its own, which comes first; an empty text counts as ``0:``; texts of any length are
    hashed whole.  A null doc_id is never tampered with.  Without siblings the proof is the digest of nothing.
    Other columns are ignored; an empty table gives no rows.
    """
    fields = [F.col(f) for f in FIELDS]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("key"), "doc_id",
        leaf(*fields).alias("digest"), leaf(*fields[:-1], trial(docs)).alias("trial"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = placed(stored(leaves, "manifest-leaves"), "key", ["doc_id", "digest", "row"]).drop("row")
    levels = levels_of(leaves)
    subroots = tops(levels).select(F.lit("").alias("key"), F.col("key").alias("tree"), "digest")
    over = levels_of(placed(stored(subroots, "manifest-subroots"), "key", ["tree"]))
    root = tops(over).first()
    ways = stored(proofs(over).select(F.col("tree").alias("key"), "steps"), "manifest-ways")
    siblings = F.transform("steps", lambda s: F.concat(s["before"], s["behind"]))
    root = F.lit(root.digest if root else None).cast("string")
    return proofs(levels, ways).select(
        "doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"),
        F.sha2(F.concat_ws("", siblings), 256).alias("proof_sha256"),
        folded(F.col("trial"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(depth: int = 8) -> str:
    """DuckDB SQL for ``manifest`` over ``documents``, for trees of up to ``FANOUT ** depth`` leaves."""
    field = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    head = " || ".join(field.format(f) for f in FIELDS[:-1])
    bits = "flatten([[(ascii(c) >> b) & 1 FOR b IN range(0, 8)] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])"
    crc = (
        f"xor(list_reduce(list_concat([4294967295], {bits}), lambda c, b: "
        "xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"
    )
    ctes = [
        f"d AS (SELECT doc_id, lang AS key, sha256({head} || {field.format('text')}) AS digest, "
        f"sha256({head} || {field.format('trial')}) AS trial FROM (SELECT *, CASE WHEN {crc} % 3 = 0 "
        f"THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS trial FROM documents))"
    ]

    def tree(name: str, source: str, order: str) -> None:
        ctes.append(
            f"{name}0 AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY {order}) - 1 AS pos, "
            f"count(*) OVER (PARTITION BY key) AS total FROM {source})"
        )
        for j in range(depth):
            ctes.append(
                f"{name}{j}r AS (SELECT key, pos // {FANOUT} AS pos, (any_value(total) + {FANOUT - 1}) // {FANOUT} AS total, "
                f"list(digest ORDER BY pos) AS run FROM {name}{j} WHERE total > 1 GROUP BY key, pos // {FANOUT})"
            )
            ctes.append(f"{name}{j + 1} AS (SELECT key, pos, total, sha256(array_to_string(run, '')) AS digest FROM {name}{j}r)")
        all_tops = " UNION ALL ".join(f"SELECT key, digest FROM {name}{j} WHERE total = 1" for j in range(depth + 1))
        ctes.append(f"{name}t AS ({all_tops})")

    def steps(name: str) -> str:
        # The slot of the leaf's ancestor and its run at each level, no run above the top
        return "[" + ", ".join(f"struct_pack(s := ({name}0.pos // {FANOUT**j}) % {FANOUT}, r := {name}{j}r.run)" for j in range(depth)) + "]"

    def joins(name: str) -> str:
        return " ".join(
            f"LEFT JOIN {name}{j}r ON {name}{j}r.key IS NOT DISTINCT FROM {name}0.key AND {name}{j}r.pos = {name}0.pos // {FANOUT**(j + 1)}"
            for j in range(depth)
        )

    tree("l", "d", "doc_id NULLS FIRST, digest")
    ctes.append("u AS (SELECT 0 AS key, key AS tree, digest FROM lt)")
    tree("u", "u", "tree NULLS FIRST")
    kept = "[x FOR x IN {0} IF x.r IS NOT NULL]"
    ctes.append(f"up AS (SELECT tree, {kept.format(steps('u'))} AS steps FROM u0 {joins('u')})")
    ctes.append(
        f"a AS (SELECT l0.doc_id, l0.digest AS leaf, l0.trial, lt.digest AS subroot, (SELECT digest FROM ut) AS root, "
        f"list_concat({kept.format(steps('l'))}, up.steps) AS steps FROM l0 {joins('l')} "
        "JOIN lt ON lt.key IS NOT DISTINCT FROM l0.key JOIN up ON up.tree IS NOT DISTINCT FROM l0.key)"
    )
    ctes.append(
        "p AS (SELECT *, [struct_pack(b := array_to_string(x.r[1:x.s], ''), e := array_to_string(x.r[x.s + 2:], '')) FOR x IN steps] AS way FROM a)"
    )
    ctes.append(
        "f AS (SELECT *, list_reduce(list_concat([struct_pack(b := trial, e := '')], way), "
        "lambda d, w: struct_pack(b := sha256(w.b || d.b || w.e), e := '')).b AS folded_root FROM p)"
    )
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, root, "
        "sha256(array_to_string([w.b || w.e FOR w IN way], '')) AS proof_sha256, folded_root, "
        "folded_root = root AS verified FROM f"
    )
