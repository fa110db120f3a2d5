"""What grows with the reviews: where rows lie, and what is written of them."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from checks import catalog
from mercata import roles
from mercata.market import Market
from mercata.ml import clusters
from mercata.plans import gold_reviews, silver
from mercata.session import SHUFFLES_GO, shuffles_dropped, tune
from mercata.sources import readers, tables
from mercata.streaming import summaries


@pytest.fixture(scope="module")
def orders_folder(spark, tmp_path_factory):
    """60 orders of 3 lines, 5 parts, 4 documents; an order and a part that are not known, and null keys."""
    folder = str(tmp_path_factory.mktemp("orders"))
    day = dt.datetime(1999, 3, 1)
    line = [(o, (o + 2 * n) % 5, n, float(o % 5), "NR"[n % 2], day) for o in range(60) for n in (1, 2, 7)]
    line += [(900, 1, 1, 1.0, "N", day), (3, 77, 1, 1.0, "N", day), (3, None, 2, 1.0, "R", day), (None, 2, 2, 1.0, "R", day)]
    tables = {
        "lineitem": (line, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(o, o % 7) for o in range(60)], "o_orderkey long, o_custkey long"),
        "part": ([(p, f"type {p % 2}", f"part {p}") for p in range(5)], "p_partkey long, p_type string, p_name string"),
        "documents": ([(0, "good"), (1, ""), (2, None), (3, "words, \"quoted\"\nand broken")], "doc_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_reviews_of_a_product_lie_together_and_none_is_lost(spark, orders_folder):
    reviews = roles.reviews(spark, orders_folder)
    assert reviews.count() == 180  # of known orders and parts only
    placed = reviews.select("asin", F.spark_partition_id().alias("place"))
    places = placed.groupBy("asin").agg(F.count_distinct("place").alias("n")).collect()
    assert len(places) == 5 and {r["n"] for r in places} == {1}


def test_review_files_are_compressed_and_read_back_whole(spark, orders_folder):
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    reviews = roles.reviews(spark, orders_folder)
    path = catalog._review_files(catalog._review_lines(reviews))
    files = glob.glob(f"{path}/source_category=*/part-*")
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert spark.conf.get(setting) == before
    columns = ["rating", "text", "parent_asin", "user_id", "source_category", "text_length"]
    again = readers.read_reviews(spark, path).select(columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, reviews.select(columns).collect()))


def test_buckets_hold_every_review_and_column_but_the_text(spark, orders_folder):
    market = roles.market(spark, orders_folder)
    market.origin = ("buckets", orders_folder)
    bucketed = catalog._bucketed_reviews(market)
    assert set(market.reviews.columns) - set(bucketed.columns) == {"text"}
    assert sorted(map(str, bucketed.collect())) == sorted(map(str, market.reviews.select(bucketed.columns).collect()))


def test_loads_need_no_texts(spark, orders_folder, tmp_path):
    reviews = roles.reviews(spark, orders_folder)
    listed = spark.createDataFrame([("1",), ("2",)], "asin string")
    late = F.col("helpful_vote") == 1
    for folder, rows in (("with", reviews), ("without", reviews.drop("text", "title"))):
        for load, part in (("first", rows.where(~late)), ("late", rows.where(late)), ("late", rows.where(late))):
            summaries.add_load(part, str(tmp_path / folder), load, listed, roles.RECENT_SINCE, roles.TREND_YEARS)
    market = Market(listings=listed, reviews=reviews, recent_since=roles.RECENT_SINCE, trend_years=roles.TREND_YEARS)
    for name in ("temporal_trends", "product_review_summary"):
        whole = sorted(map(str, getattr(market, name).collect()))
        for folder in ("with", "without"):
            assert sorted(map(str, summaries.table(spark, str(tmp_path / folder), name).collect())) == whole


def test_keywords_split_each_text_once(spark, orders_folder):
    references = roles.review_references(spark, orders_folder)
    texts = roles.review_texts(spark, orders_folder).withColumnRenamed("doc_id", "text_id")
    twice = texts.unionByName(texts.where("text_id = 0"))  # a repeated id attaches both its texts
    for given in (texts, twice):
        attached = references.join(given, "text_id", "left")
        for pct in (100.0, 40.0):
            whole = gold_reviews.review_keywords(attached, "text", 1, pct).collect()
            split = gold_reviews.review_keywords(references, "text_id", 1, pct, texts=given)
            assert whole and sorted(map(str, split.collect())) == sorted(map(str, whole))
    found = catalog.QUERIES["G21_review_keywords_whole_text"](spark, orders_folder)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan[plan.index("Generate"):].split("Join")[0] and plan.index("Join") < plan.index("Generate")


def test_sketches_and_their_ranks_read_the_written_lengths(spark, orders_folder):
    found = catalog.QUERIES["A5_merged_sketch_p90"](spark, orders_folder)
    assert found.collect() and all(r.within_bound for r in found.collect())
    assert sum(r.texts for r in found.collect()) == roles.reviews(spark, orders_folder).where("text_length is not null").count()
    assert "lineitem" not in found._jdf.queryExecution().optimizedPlan().toString() and not any("lineitem" in f for f in found.inputFiles())


def test_shuffles_start_in_more_parts_than_the_session_asks_for(spark, orders_folder):
    """With the session's 4 parts a task would hold a quarter of the reviews, however many there are."""
    tune(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    plan = roles.review_references(spark, orders_folder)._jdf.queryExecution().executedPlan().toString()
    spread = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_partkey" in line]
    assert spread and all(int(line.split(",")[1].strip(" )")) >= 200 for line in spread)


RATED = [
    (p, c, u, r, len(str(u)), r > 2, r % 2, u != "c", n, dt.date(2000, 1, 1 + n))
    for n, (p, c, u, r) in enumerate([
        ("1", "x", "a", 5.0), ("1", "x", "a", 1.0), ("1", "x", "b", 3.0), ("1", None, "c", 5.0), ("2", "x", "a", 4.0), ("2", "x", None, 2.0),
        ("3", "y", None, 1.0), ("U1", "y", "d", 5.0), (None, "y", "d", 5.0), (None, None, "e", 2.0), ("1", "x", "a", 5.0),
    ])
]
RATED_SCHEMA = (
    "parent_asin string, source_category string, user_id string, rating double, text_length long, verified_purchase boolean, "
    "helpful_vote double, has_text boolean, image_count long, review_date date"
)


def users_are_narrow(df):
    """Aggregates by user hold no sums."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    by_user = [line for line in plan.splitlines() if "Aggregate [" in line and "user_id" in line.split("]")[0]]
    counts = [line for line in plan.splitlines() if "Aggregate [" in line and "count(distinct user_id" in line]
    return (by_user or counts) and not any(" sum(" in line or "count_if" in line or "helpful" in line or "CASE" in line for line in by_user + counts)


def test_users_of_a_category_are_counted_apart_from_its_sums(frame):
    trust = gold_reviews.review_trust(frame(RATED, RATED_SCHEMA))
    assert users_are_narrow(trust)
    found = {r.source_category: r for r in trust.collect()}
    assert {c: (r.total_reviews, r.unique_reviewers, r.reviews_per_reviewer) for c, r in found.items()} == {
        "x": (6, 2, 3.0), "y": (3, 1, 3.0), None: (2, 2, 1.0)}
    assert trust.columns[:5] == ["source_category", "total_reviews", "unique_reviewers", "reviews_per_reviewer", "pct_verified"]
    only = gold_reviews.review_trust(frame([r for r in RATED if r[2] is None], RATED_SCHEMA)).collect()
    assert {(r.unique_reviewers, r.reviews_per_reviewer) for r in only} == {(0, None)}


def test_users_of_a_product_are_counted_apart_from_its_sums(frame):
    listed = frame([("1",), ("2",), ("3",), ("1",), (None,)], "asin string")
    trust = gold_reviews.product_review_trust(frame(RATED, RATED_SCHEMA), listed)
    assert users_are_narrow(trust)
    found = {(r.parent_asin, r.source_category): (r.review_count, r.unique_reviewers, r.reviews_per_reviewer) for r in trust.collect()}
    assert found == {("1", "x"): (4, 2, 2.0), ("1", None): (1, 1, 1.0), ("2", "x"): (2, 1, 2.0), ("3", "y"): (1, 0, None)}
    assert trust.columns[:5] == ["parent_asin", "source_category", "review_count", "unique_reviewers", "reviews_per_reviewer"]
    plan = trust._jdf.queryExecution().optimizedPlan().toString().splitlines()
    semi = next(i for i, line in enumerate(plan) if "LeftSemi" in line)
    assert any("Aggregate [" in line for line in plan[semi + 1:semi + 3])  # products, not reviews, meet the listings


def test_appended_reviews_are_not_sorted_first(spark, orders_folder, tmp_path):
    """Whole texts are written as they come, in small row groups, and the session's own setting stays."""
    setting, path = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "appended")
    before, reviews = spark.conf.get(setting), roles.reviews(spark, orders_folder)
    seen = []
    writer = type(spark.conf)
    original = writer.set
    writer.set = lambda self, key, value: (seen.append((key, value)), original(self, key, value))[1]
    try:
        for load in ("first", "late", "late"):
            tables.append_reviews(reviews, path, load)
    finally:
        writer.set = original
    assert seen.count((setting, tables.OPEN_FILES)) == 3 and spark.conf.get(setting) == before
    again = spark.read.parquet(path)
    assert again.groupBy("load").count().count() == 2 and again.count() == 2 * reviews.count()
    kept = ["text", "user_id", "parent_asin", "source_category"]
    assert sorted(map(str, again.where("load = 'late'").select(kept).collect())) == sorted(map(str, reviews.select(kept).collect()))


def test_facts_are_the_reviews_without_titles_and_texts(spark, orders_folder, tmp_path):
    for name in ("orders", "documents", "part"):  # repeated keys give each review as often as before
        rows = spark.read.parquet(f"{orders_folder}/{name}.parquet")
        rows.unionByName(rows.limit(2)).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{orders_folder}/lineitem.parquet")
    gaps = lines.limit(9).select("l_orderkey", "l_partkey", *[
        F.when(F.monotonically_increasing_id() % 4 != i, F.col(c)).alias(c) for i, c in enumerate(lines.columns[2:])])
    lines.unionByName(gaps).withColumn("l_quantity", F.when(F.col("l_linenumber") == 7, -3.0).otherwise(F.col("l_quantity"))).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    for folder in (orders_folder, str(tmp_path)):
        facts = roles.review_facts(spark, folder)
        whole = roles.reviews(spark, folder).select(facts.columns)
        assert set(roles.reviews(spark, folder).columns) - set(facts.columns) == {"title", "text"}
        assert sorted(map(str, facts.collect())) == sorted(map(str, whole.collect())) and facts.count() >= 180
    plan = facts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(plan) if "doc_id" in line and "Join" in line)
    assert not any("lineitem" in line or "l_partkey" in line for line in plan[joined:])  # lengths meet the orders, not the lines


def test_trust_and_summary_read_the_written_facts(spark, frame, orders_folder):
    """The lines are read and shuffled once, for the facts, not for trust, its users and the summary anew."""
    market, whole = roles.market(spark, orders_folder), roles.market(spark, orders_folder)
    market.origin = ("facts", orders_folder)
    for m in (market, whole):
        m.__dict__["listings"] = frame([(str(p),) for p in range(5)], "asin string")
    catalog.with_facts(market)
    for name in ("product_review_trust", "product_review_summary"):
        found = getattr(market, name)
        assert "l_partkey" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, found.collect())) == sorted(map(str, getattr(whole, name).collect()))
    make = {"product_review_trust": gold_reviews.product_review_trust, "product_review_summary": gold_reviews.product_review_summary}
    for name, of in make.items():
        plain = of(roles.reviews(spark, orders_folder).transform(silver.reviews), market.listings, *([market.recent_since] if "summary" in name else []))
        assert sorted(map(str, plain.collect())) == sorted(map(str, getattr(market, name).collect()))


def test_written_reviews_take_the_place_of_given_facts(spark, orders_folder, tmp_path):
    market = roles.market(spark, orders_folder)
    market.write(str(tmp_path), ["raw_reviews"])
    assert "l_partkey" not in market.review_facts._jdf.queryExecution().optimizedPlan().toString()


def test_users_in_shares_are_the_same_users(frame):
    many = RATED + [(str(n % 3), "x", f"user {n % 40}", *RATED[0][3:]) for n in range(200)]
    reviews = frame(many, RATED_SCHEMA)
    plain, dealt = (gold_reviews.reviewers(reviews, gold_reviews.PRODUCT, n) for n in (None, gold_reviews.SHARES))
    exchanges = [line for line in dealt._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and not any("user_id" in line for line in exchanges)
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))


def test_shuffles_of_written_tables_are_dropped(spark, tmp_path):
    with shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLES_GO) == "true"
    assert spark.conf.get(SHUFFLES_GO, "false") == "false"
    seen, writer, before = [], type(spark.conf), type(spark.conf).set
    writer.set = lambda self, key, value: (seen.append((key, value)), before(self, key, value))[1]
    try:
        tables.materialize(spark.range(100).repartition(5, "id"), str(tmp_path / "t"))
        clusters.checkpointed(spark.range(100).repartition(5, "id"))
    finally:
        writer.set = before
    assert seen == [(SHUFFLES_GO, "true"), (SHUFFLES_GO, "false")] * 2


def test_words_meet_a_category_once_and_texts_are_dealt_once(spark, frame):
    """Sentiments are columns in the shuffle by word, and words are counted where their texts lie."""
    reviews = frame([(c, r, "u", i) for i in (0, 1, 2, None) for c in ("x", None) for r in (1.0, 3.0, 5.0, None) if (i, c) != (2, "x")],
                    "source_category string, rating double, user_id string, text_id long")
    texts = frame([(0, "red red blue"), (1, "Blue the"), (1, "green"), (2, "red"), (3, "unseen"), (None, "lost"), (2, None)], "text_id long, text string")
    found = gold_reviews.review_keywords(reviews, "text_id", 1, texts=texts)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(text_id" in plan and not any("word" in line and "text_id" in line for line in plan.splitlines() if "Exchange" in line)
    assert not any("sentiment" in line for line in plan.splitlines() if "Exchange" in line)
    whole = gold_reviews.review_keywords(reviews.join(texts, "text_id", "left"), "text", 1)
    assert found.columns == whole.columns and sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert {(r.source_category, r.sentiment, r.word_count) for r in found.where("word = 'red'").collect()} == {
        ("x", "negative", 2), ("x", "neutral", 4), ("x", "positive", 2), (None, "negative", 3), (None, "neutral", 6), (None, "positive", 3)}
    some = [r for r in whole.collect() if r.word_count >= 2]
    assert sorted(map(str, gold_reviews.review_keywords(reviews, "text_id", 2, texts=texts).collect())) == sorted(map(str, some))
