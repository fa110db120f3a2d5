"""Summaries kept load by load against those of all reviews at once; sketches against exact answers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from mercata.operators import sketches
from mercata.plans import gold_reviews, silver
from mercata.sources import readers
from mercata.streaming import summaries
from mercata.streaming.incremental import refresh_reviews

KEYS = {"temporal_trends": summaries.MONTH, "product_review_summary": gold_reviews.PRODUCT}


def lines(rng, n, products=12):
    day = 86_400_000
    return [
        json.dumps({
            "rating": rng.choice([1.0, 1.5, 2.0, 3.0, 4.0, 4.5, 5.0, None]), "title": rng.choice(["t", "", None]),
            "text": rng.choice(["", None, "some text", "é" * 9]), "images": rng.choice([None, [], [{"small_image_url": "x"}]]),
            "asin": "A", "parent_asin": f"P{rng.randrange(products)}", "user_id": f"u{rng.randrange(50)}",
            "timestamp": 1_600_000_000_000 + rng.randrange(900) * day, "helpful_vote": rng.choice([0, 3, None]),
            "verified_purchase": rng.choice([True, False, None]),
        })
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def reviews(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("reviews")
    rng = random.Random(4)
    for name in ("Books", "Toys", "12"):  # a category that looks like a number stays text
        (folder / f"{name}.jsonl").write_text("\n".join(lines(rng, 150)))
    return readers.read_reviews(spark, str(folder)).withColumn("load", F.pmod(F.xxhash64("timestamp", "text"), F.lit(3)))


def same(spark, folder, reviews, products=None):
    dated = silver.reviews(reviews.drop("load"))
    known = dated.select(F.col("parent_asin").alias("asin")).distinct() if products is None else products
    whole = {
        "temporal_trends": gold_reviews.temporal_trends(dated), "product_review_summary": gold_reviews.product_review_summary(dated, known),
    }
    for name, want in whole.items():
        got = summaries.table(spark, folder, name)
        assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_loads_add_up_and_a_repeated_load_replaces_itself(spark, tmp_path, reviews):
    folder = str(tmp_path)
    part = lambda i: reviews.where(F.col("load") == i)
    summaries.add_load(part(0).where("source_category = 'Books'"), folder, "a")
    same(spark, folder, part(0).where("source_category = 'Books'"))
    summaries.add_load(part(1), folder, "b")
    summaries.add_load(part(2), folder, "b")  # the load again, with other reviews
    summaries.add_load(part(2), folder, "b")
    same(spark, folder, part(0).where("source_category = 'Books'").unionByName(part(2)))
    summaries.add_load(part(2).where("source_category = 'Toys'"), folder, "b")  # and again, without two categories
    same(spark, folder, part(0).where("source_category = 'Books'").unionByName(part(2).where("source_category = 'Toys'")))


def test_a_late_load_leaves_other_categories_alone(spark, tmp_path, reviews):
    folder = str(tmp_path)
    summaries.add_load(reviews.where("source_category <> '12'"), folder, "first")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("*/source_category=Toys/*.parquet")}
    summaries.add_load(reviews.where("source_category = '12'"), folder, "late")
    assert before and before == {p: p.stat().st_mtime_ns for p in tmp_path.glob("*/source_category=Toys/*.parquet")}
    same(spark, folder, reviews)
    with pytest.raises(ValueError, match="named by"):
        summaries.add_load(reviews, folder, "a/b")


def test_merged_partials_are_partials(spark, reviews):
    dated = silver.reviews(reviews.drop("load"))
    parts = summaries.partials(dated, summaries.MONTH)
    twice = summaries.merged(parts.unionByName(parts), summaries.MONTH)
    one = {r[:3]: r.review_count for r in summaries.trends_of(parts).collect()}
    assert {r[:3]: r.review_count for r in summaries.trends_of(twice).collect()} == {k: 2 * v for k, v in one.items()}


def test_arriving_files_renew_the_summaries(spark, tmp_path):
    inbox, folder, rng = tmp_path / "in", str(tmp_path / "made"), random.Random(1)
    inbox.mkdir()
    listed = spark.createDataFrame([("P1",), ("P2",)], "asin string")
    args = (spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "state"))
    for name in ("Books", "Toys", "Books.part2"):
        (inbox / f"{name}.jsonl").write_text("\n".join(lines(rng, 60)))
        refresh_reviews(*args, summary_folder=folder, products=listed)
    same(spark, folder, readers.read_reviews(spark, str(inbox)), listed)


def exact_quantile(values, q):
    values = sorted(values)
    place = (len(values) - 1) * q
    low, high = values[int(place)], values[min(int(place) + 1, len(values) - 1)]
    return low + (high - low) * (place - int(place))


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_sketches_of_small_groups_give_exact_quantiles(spark, q):
    rng = random.Random(7)
    groups = {f"g{n}": [rng.choice([1.0, 1.5, rng.random() * 100]) for _ in range(n)] for n in (1, 2, 3, 4, 10, 101, 511)}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("g2", None), ("none", None)]
    made = sketches.quantile_sketches(spark.createDataFrame(rows, "g string, x double"), ["g"], "x")
    got = {r.g: r.v for r in made.select("g", sketches.sketch_quantile("sketch", q).alias("v")).collect()}
    assert got == {**{g: pytest.approx(exact_quantile(xs, q)) for g, xs in groups.items()}, "none": None}


def test_merged_sketches_stay_within_their_bounds(spark):
    """One key with most rows, values with many ties, and values that several parts share."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("g"), F.pmod("id", F.lit(37)).alias("part"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) * F.pmod(F.xxhash64("id"), F.lit(7))).alias("x"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9_000)).alias("user"),
    )
    parts = sketches.quantile_sketches(rows, ["g", "part"], "x")
    for q in (0.01, 0.5, 0.99):
        merged = sketches.merge_quantiles(parts, ["g"]).select("g", sketches.sketch_quantile("sketch", q).alias("estimate"))
        assert [r.within for r in sketches.rank_checked(rows, ["g"], "x", q, merged).collect()] == [True, True]
    off = spark.createDataFrame([("hot", 9.0), ("cold", 9.0)], "g string, estimate double")
    assert not any(r.within for r in sketches.rank_checked(rows, ["g"], "x", 0.99, off).collect())
    users = sketches.distinct_sketches(rows, ["g", "part"], "user")
    merged = sketches.merge_distinct(users, ["g"])
    assert all(r.within for r in sketches.distinct_checked(rows, ["g"], "user", merged).collect())
    one = sketches.distinct_sketches(rows, ["g"], "user")
    estimate = sketches.sketch_distinct("sketch").alias("n")
    assert sorted(merged.select("g", estimate).collect()) == sorted(one.select("g", estimate).collect())
