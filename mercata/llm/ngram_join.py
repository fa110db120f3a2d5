"""Jaccard join of word-shingle sets: a size-aware heavy-light join.

Documents with equal sets count as one from the start.  Tokens (shingle hashes) have one global
order: rare ones by hash, then the heavy ones, which more than ``HEAVY`` documents hold
among their first tokens.  Two similar sets share tokens among the first few of each.

* Small sets post the pairs among their first tokens (subsets of fixed size two); similar small
  sets share such a pair, and few others do.
* Large sets scan inverted lists of single tokens.  The number of list entries that two sets
  share bounds their overlap from above, which leaves few pairs to compare.

The size that parts small from large sets has the lowest cost, counted from the lists and the
sizes themselves.

A set with too few rare tokens among its emitted ones is *bound*; it meets the other sets by the rare
tokens of its whole text.  Among bound sets, tokens that many of them hold come last as well.  What
then still lacks rare tokens belongs to a large group of near copies.  Such sets form families, which
share tokens of their fronts; a family is compared in tiles of bounded size, whose inverted
lists give exact overlaps and from which only a spanning forest of links comes out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mercata.llm.graph import components
from mercata.llm.shingles import WORDS, shingle_sets
from mercata.llm.support import discard, picked, stored

SHARE = 85              # hundredths of the union that similar sets have in common, by default
HEAVY = 32              # lists longer than this are heavy
BOUNDARIES = (0, 13, 20, 32, 48)  # sizes among which the largest small set is chosen
TILE_SETS = 2_048       # sets of a family on either side of a tile, about
TILE_TOKENS = 2_000_000  # tokens of these sets, about


def lowest(n: Column, share: int = SHARE) -> Column:
    """Size of the smallest set that can be similar to one of size n."""
    return F.ceil(n * share / 100).cast("int")


def overlap(n: Column, m: Column, share: int = SHARE) -> Column:
    """Common tokens that similar sets of sizes n and m have at least."""
    return F.ceil((n + m) * share / (100 + share)).cast("int")


def first_tokens(n: Column, share: int = SHARE) -> Column:
    """Tokens from the front of a set's order, two of which any similar set shares among its own."""
    return (n - lowest(n, share) + 2).cast("int")


def emitted(n: int, share: int = SHARE) -> int:
    """Tokens kept in hash order: the first ones, and spare ones in place of heavy tokens."""
    first = n - -(-n * share // 100) + 2
    return min(n, first + first // 4 + 8)


def smallest_linked(share: int = SHARE) -> int:
    """Smallest set that can be similar to a different one."""
    n = 1
    while 100 * n < share * (n + 1):
        n += 1
    return n


def token_sets(docs: DataFrame, whole: bool, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, print, tokens): the set's size, a fingerprint, and its sorted tokens,
    all of them or the emitted ones; an empty set has no fingerprint."""
    def run(batches):
        import xxhash

        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), words))
            prints = [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets]
            kept = sets if whole else [s[:emitted(len(s), share)] if len(s) >= least else s[:0] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.string()),
                 pa.array(kept, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "print", "tokens"],
            )

    least = smallest_linked(share)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, print string, tokens array<long>"
    )


def boundary(scans: Observation, sizes: list, share: int = SHARE) -> int:
    """The largest small set: enumerating pairs costs what they number, scanning costs list entries
    and the pairs of entries of a list."""
    found = scans.get
    costs = {}
    for at in BOUNDARIES:
        pairs = sum(c * (p * (p - 1) // 2) for n, p, c in sizes if n <= at)
        entries = sum(c * p for n, p, c in sizes if 100 * n > share * at)
        costs[at] = pairs + entries + float(found[f"scan_{at}"] or 0)
    return min(costs, key=costs.get)


def verified(pairs: DataFrame, docs: DataFrame, words: int, share: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    pairs = stored(pairs.select("a", "b"), "ngram-pairs")
    if pairs.isEmpty():
        return pairs
    ids = stored(pairs.select("a").union(pairs.select("b")).distinct(), "ngram-ids")
    sets = stored(token_sets(picked(docs, ids, "doc_id"), True, words, share).select("doc_id", "tokens"), "ngram-sets")
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("tokens").alias(f"{c}_tokens"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    similar = common * 100 >= (F.size("a_tokens") + F.size("b_tokens") - common) * share
    links = stored(both.filter(similar).select("a", "b"), "ngram-links")
    discard(sets)
    return links


def bounded_pairs(entries: DataFrame, small: int, share: int) -> DataFrame:
    """Pairs of entries (token, doc, n, bound, perhaps kind) of a list, not both of bound sets, with the number ``shared`` of
    lists they share; pairs that cannot overlap enough are left out.

    Unbound sets meet each other and, in a join of their own, bound ones: a list holds few unbound sets, so the pairs that are
    tried grow with a list's length, not with its square, and a list of bound sets alone is tried not at all."""
    kinds = ["kind"] if "kind" in entries.columns else []

    def met(a: DataFrame, b: DataFrame, ordered: bool) -> DataFrame:
        a, b = a.alias("a"), b.alias("b")
        cond = (F.col("a.n") * 100 >= F.col("b.n") * share) & (F.col("b.n") * 100 >= F.col("a.n") * share)
        for c in ["token", *kinds]:
            cond = cond & (F.col(f"a.{c}") == F.col(f"b.{c}"))
        for _ in kinds:
            cond = cond & ((F.col("a.kind") == 2) | (F.greatest("a.n", "b.n") > small))
        cond = cond & (F.col("a.doc") < F.col("b.doc") if ordered else F.col("a.doc") != F.col("b.doc"))
        first, last = F.struct("a.doc", "a.n"), F.struct("b.doc", "b.n")
        return a.join(b, cond).select(F.least(first, last).alias("a"), F.greatest(first, last).alias("b"))

    unbound = entries.filter(~F.col("bound"))
    every = met(unbound, unbound, True).unionByName(met(unbound, entries.filter("bound"), False))
    pairs = every.groupBy(
        F.col("a.doc").alias("a"), F.col("b.doc").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")
    ).agg(F.count(F.lit(1)).alias("shared"))
    beyond = F.greatest(F.col("n_a") - first_tokens(F.col("n_a"), share), F.col("n_b") - first_tokens(F.col("n_b"), share))
    enough = F.col("shared") + beyond >= overlap(F.col("n_a"), F.col("n_b"), share)
    return pairs.filter(enough | (F.greatest("n_a", "n_b") <= small)).select("a", "b", "shared")


def subsets(tokens: Column) -> Column:
    """Hashes of all pairs of an array's tokens."""
    return F.flatten(F.transform(
        tokens, lambda x, i: F.transform(F.filter(tokens, lambda _, j: j > i), lambda y: F.xxhash64(x, y))
    ))


def similar_sets(docs: DataFrame, words: int, share: int) -> tuple[DataFrame, DataFrame]:
    """All documents' sets (doc_id, n_shingles, print), and the components of sets that links
    reach: (node, component), a node being the smallest doc_id of a set."""
    sets = stored(token_sets(docs, False, words, share), "ngram-sets")
    same = sets.filter("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("node"))
    copies = stored(
        sets.select("doc_id", "print").join(same, "print").filter("doc_id <> node").select("doc_id"), "ngram-copies"
    )
    fit = sets.filter(F.size("tokens") > 0).filter("doc_id is not null")
    nodes = picked(fit, copies, "doc_id", "left_anti").select(
        F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "tokens"
    )
    count = F.count(F.lit(1))
    lists = nodes.select(F.explode("tokens").alias("token"), "n").groupBy("token").agg(
        count.alias("length"),
        *[F.count(F.when(F.col("n") * 100 > share * at, 1)).alias(f"in_{at}") for at in BOUNDARIES],
    )
    scans = Observation("ngram-scan")
    light = F.col("length") <= HEAVY
    pairs_of = lambda c: F.when(light, c * (c - 1) / 2).otherwise(0)
    heavy = stored(
        lists.observe(scans, *[F.sum(pairs_of(F.col(f"in_{at}"))).alias(f"scan_{at}") for at in BOUNDARIES])
        .filter(~light).select("token"), "ngram-heavy",
    )
    first = first_tokens(F.col("n"), share)
    sizes = (
        nodes.filter(F.col("n") <= 4 * max(BOUNDARIES)).groupBy("n", first.alias("p")).agg(count.alias("c"))
    )  # at most 4 * max(BOUNDARIES) rows; larger sets scan lists at every boundary
    small = boundary(scans, [(r["n"], r["p"], r["c"]) for r in sizes.collect()], share)

    # rare tokens of every set, in hash order
    tokens = nodes.select("doc", "n", F.posexplode("tokens").alias("place", "token"))
    held = (
        tokens.join(heavy, "token").groupBy("doc").agg(F.collect_set("token").alias("heavy"))
    )
    marked = nodes.join(held, "doc", "left")
    rare = F.when(F.col("heavy").isNull(), F.col("tokens")).otherwise(F.array_except("tokens", "heavy"))
    marked = stored(
        marked.withColumn("rare", rare).withColumn("bound", F.size("rare") < first)
        .select("doc", "n", "bound", F.when(F.col("bound"), F.col("tokens")).otherwise(F.slice("rare", F.lit(1), first)).alias("tokens")),
        "ngram-marked",
    )

    # bound sets: rare tokens of the whole text, without those that many bound sets hold, too
    texts = picked(docs, marked.filter("bound").select("doc"), "doc_id")
    full = stored(
        token_sets(texts, True, words, share).select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "tokens"), "ngram-full"
    )
    front = lambda rows: rows.groupBy("doc", "n").agg(F.sort_array(F.collect_set("token")).alias("all")).select(
        "doc", "n", (F.size("all") < first).alias("bound"), F.slice("all", F.lit(1), first).alias("tokens")
    )
    deep = stored(full.select("doc", "n", F.explode("tokens").alias("token")).join(heavy, "token", "left_anti"), "ngram-deep")
    rest = front(deep).withColumn("bound", F.lit(True))
    crowded = deep.groupBy("token").agg(count.alias("length")).filter(F.col("length") > HEAVY).select("token")
    freed = stored(front(deep.join(crowded, "token", "left_anti")), "ngram-freed")
    family = full.join(freed.filter("not bound").select("doc"), "doc", "left_anti")
    among = bounded_pairs(freed.select("doc", "n", "bound", F.explode("tokens").alias("token")), 0, share)
    every = marked.filter("not bound").unionByName(rest)
    single = every.filter(F.col("n") * 100 > share * small).select(
        "doc", "n", "bound", F.lit(1).alias("kind"), F.explode("tokens").alias("token")
    )
    entries = single
    if small:
        entries = single.unionByName(every.filter(F.col("n") <= small).select(
            "doc", "n", "bound", F.lit(2).alias("kind"), F.explode(subsets(F.col("tokens"))).alias("token")
        ))
    general = bounded_pairs(entries, small, share)

    pairs = stored(general.unionByName(among), "ngram-candidates")

    # the most promising partner of each set first, then whatever lies between components
    fronts = marked.filter("bound").select("doc", F.slice("tokens", F.lit(1), first).alias("front"))
    near = stored(in_families(family, fronts, share), "ngram-links")
    links = verified(promising(pairs), docs, words, share).union(near)
    more = verified(apart(pairs.select("a", "b"), stored(components(links), "ngram-components")), docs, words, share)
    return sets.select("doc_id", "n_shingles", "print"), components(links.union(more))


def in_families(sets: DataFrame, fronts: DataFrame, share: int) -> DataFrame:
    """A spanning forest (a, b) of the links among ``sets`` (doc, n, tokens), similar pairs of which share
    a token of their ``fronts`` (doc, front)."""
    entries = sets.select("doc").join(fronts, "doc").select("doc", F.explode("front").alias("token"))
    least = entries.groupBy("token").agg(F.min("doc").alias("least"))
    related = entries.join(least, "token").select(F.col("doc").alias("a"), F.col("least").alias("b"))
    families = stored(components(related.distinct()), "ngram-families").select(F.col("node").alias("doc"), F.col("component").alias("family"))
    members = sets.join(families, "doc")
    sizes = members.groupBy("family").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / TILE_SETS, F.sum("n") / TILE_TOKENS)).cast("int").alias("blocks")
    )
    placed = members.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = placed.withColumn("other", other).select(
        "family", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        (F.col("block") < F.col("other")).alias("on_left"), "doc", "tokens",
    )

    def run(rows: pa.Table) -> pa.Table:
        ids, on_left = rows.column("doc").to_numpy(), rows.column("on_left").to_numpy(zero_copy_only=False)
        tokens = rows.column("tokens").combine_chunks()
        links = forest(ids, np.diff(tokens.offsets.to_numpy()), tokens.flatten().to_numpy(), on_left, share)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return tiles.groupBy("family", "left", "right").applyInArrow(run, "a long, b long")


def forest(ids: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, on_left: np.ndarray, share: int = SHARE) -> list[tuple]:
    """Links (smaller id, larger id) that join what similar pairs join: pairs between the sets on the left
    and the others, or all pairs where no set is on the left."""
    owner = np.repeat(np.arange(len(ids)), sizes)
    _, token, length = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.argsort(token, kind="stable")
    lists, start = owner[order], np.concatenate([[0], np.cumsum(length)])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, split = [], on_left.any()
    for i in np.flatnonzero(on_left) if split else range(len(ids)):
        mine = token[begin[i]:begin[i + 1]]
        mine = mine[length[mine] > 1]
        if not len(mine):
            continue
        common = np.bincount(np.concatenate([lists[start[t]:start[t + 1]] for t in mine]), minlength=len(ids))
        similar = common * 100 >= (sizes + sizes[i] - common) * share
        similar[i] = False
        for j in np.flatnonzero(similar & ~on_left if split else similar):
            a, b = find(i), find(int(j))
            if a != b and ids[i] != ids[j]:
                root[a] = b
                links.append((min(int(ids[i]), int(ids[j])), max(int(ids[i]), int(ids[j]))))
    return links


def promising(pairs: DataFrame) -> DataFrame:
    """Per set the pair with the partner that shares most lists with it."""
    both = pairs.union(pairs.select(F.col("b"), F.col("a"), "shared"))
    best = both.groupBy("a").agg(F.max(F.struct("shared", (-F.col("b")).alias("b"))).alias("best"))
    other = -F.col("best.b")
    return best.select(F.least("a", other).alias("a"), F.greatest("a", other).alias("b")).distinct()


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    of = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
    joined = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return joined.filter(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b")


def near_copies(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    A-Z count as a-z; words are runs of other than ASCII white space.  A set is the distinct runs of
    ``words`` words of the whole text, or the whole sequence of fewer words.  Two documents link when their sets'
    intersection has at least ``share`` hundredths (51 to 99) of their union; component_id is the smallest doc_id reachable by links.  Null, empty and
    wordless texts have no shingles and stay alone.  Rows with the same doc_id are one document, linked through
    any of them.  A row without an id takes the component of its equals, or null.  Other columns are ignored.
    """
    if words < 1 or not 50 < share < 100:  # similar sets that differ share two tokens only above one half
        raise ValueError(f"words {words} or share {share} out of range")
    sets, reached = similar_sets(docs, words, share)
    same = sets.filter("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("node"))
    classes = same.join(reached, "node", "left").select("print", F.coalesce("component", "node").alias("component_id"))
    return sets.join(classes, "print", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """The rows and columns of ``docs`` whose document is the smallest id of its component.

    Of several rows with one id the first in order of their columns stays; rows without an id stay."""
    found = stored(near_copies(docs, words, share).filter("doc_id is not null").select("doc_id", "component_id"), "ngram-classes")
    later = stored(found.filter("component_id <> doc_id").select("doc_id").distinct(), "ngram-later")
    kept = picked(docs, later, "doc_id", "left_anti")
    twice = found.filter("component_id = doc_id").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    twice = stored(twice, "ngram-twice")
    if twice.isEmpty():
        return kept
    once, rows = picked(kept, twice, "doc_id", "left_anti"), picked(kept, twice, "doc_id")
    rows = rows.select(F.struct("*").alias("row")).groupBy("row.doc_id").agg(F.min("row").alias("row")).select("row.*")
    return once.unionByName(rows)
