import gzip
import json
import random
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercata.plans import gold_reviews, silver
from mercata.sources import csv_ranges, readers, tables
from mercata.streaming.incremental import refresh_reviews


def review(**kw):
    base = {
        "rating": 5.0, "title": "t", "text": "some text", "images": [], "asin": "A", "parent_asin": "P",
        "user_id": "u", "timestamp": 1640995200000, "helpful_vote": 0, "verified_purchase": True,
    }
    return json.dumps({**base, **kw})


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")


def test_metadata_folder_keeps_prices_and_line_breaks(spark, tmp_path):
    header = (
        "parent_asin,main_category,title,average_rating,rating_number,price,store,features,description,"
        "categories,details_brand,details_manufacturer\n"
    )
    (tmp_path / "meta_A.csv").write_text(
        header + 'p1,Cat,"A ""quoted"" title",4.5,10,"$1,234.50",S,"[\'line one\nline two\']",,[],,\n'
    )
    (tmp_path / "meta_B.csv").write_text(header + "p2,,Plain,,0,—,,[],desc,[],B,M\n")
    rows = {r.parent_asin: r for r in readers.read_metadata(spark, str(tmp_path)).collect()}
    assert rows["p1"].title == 'A "quoted" title' and rows["p1"].features == "['line one\nline two']"
    assert (rows["p1"].price, rows["p1"].rating_tenths, rows["p1"].flag_no_brand) == ("$1,234.50", 45, True)
    assert (rows["p2"].flag_no_price, rows["p2"].flag_no_store, rows["p2"].flag_no_ratings) == (True, True, True)
    assert rows["p2"].main_category is None
    both = readers.union_all(spark, [str(tmp_path / "meta_A.csv"), str(tmp_path / "meta_B.csv")], readers.read_metadata)
    assert both.count() == 2


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def quoted_file(rng, rows, end):
    """CSV text with line breaks, quotes, commas and empty fields, some records longer than a byte range."""
    out = ["a,b,c" + end]
    for i in range(rows):
        words = ["x", 'say ""hi""', end, "\n", ",", "é", '""', end + end, " "]
        text = "".join(rng.choices(words, k=rng.choice([0, 1, 3, 9, 400 if i % 17 == 0 else 5])))
        out.append(f'{i},"{text}",' + rng.choice(["", '""', "plain", f'"{end}"', " spaced "]) + end)
        if rng.random() < 0.1:
            out.append(end)  # an empty line between records
    return "".join(out)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_are_read_in_byte_ranges(spark, tmp_path, small_ranges, end):
    rng = random.Random(len(end))
    for name, rows in (("one.csv", 300), ("two.csv", 40), ("three.csv", 0)):
        (tmp_path / name).write_bytes(quoted_file(rng, rows, end).encode())
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])
    got = csv_ranges.read(spark, str(tmp_path), schema, readers.CSV)
    want = spark.read.schema(schema).option("header", True).option("multiLine", True).options(**readers.CSV).csv(str(tmp_path))
    assert csv_ranges.lines(spark, str(tmp_path / "one.csv")).rdd.getNumPartitions() > 10
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() == 340


def test_a_quoted_field_may_last_to_the_end_of_the_file(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('a,b\n1,"' + "long\n" * 1_000 + '"')
    (tmp_path / "b.csv").write_text("a,b\n2,x")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    rows = sorted(csv_ranges.read(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema, readers.CSV).collect())
    assert [tuple(r) for r in rows] == [(1, "long\n" * 1_000), (2, "x")]


def test_listings_and_categories(spark, tmp_path):
    (tmp_path / "listings.csv").write_text(
        "asin,title,imgUrl,productURL,stars,reviews,price,listPrice,category_id,isBestSeller,boughtInLastMonth\n"
        "a1,Thing,i,u,4.5,10,9.99,19.98,1,True,50\na2,,i,u,0.0,0,,0.0,2,False,0\n"
    )
    rows = {r.asin: r for r in readers.read_listings(spark, str(tmp_path / "listings.csv")).collect()}
    assert (rows["a1"].price_cents, rows["a1"].list_cents, rows["a1"].rating_tenths) == (999, 1998, 45)
    assert rows["a1"].is_best_seller and not rows["a1"].flag_no_sales
    flags = [c for c in rows["a2"].asDict() if c.startswith("flag_")]
    assert all(rows["a2"][f] for f in flags)
    (tmp_path / "categories.csv").write_text("id,category_name\n1, Toys \n2,\n3,\" \"\n")
    got = {r.id: (r.flag_missing_name, r.name_length) for r in readers.read_categories(spark, str(tmp_path / "categories.csv")).collect()}
    assert got == {1: (0, 4), 2: (1, None), 3: (1, 0)}


def test_reviews_take_their_category_from_the_file(spark, tmp_path):
    write(tmp_path / "Toys_and_Games.jsonl", review(images=[{"small_image_url": "x"}, {}]), review(images=None, text=""))
    write(tmp_path / "Books.jsonl", review(text="é" * 20))
    rows = readers.read_reviews(spark, str(tmp_path)).collect()
    assert sorted((r.source_category, r.image_count, r.text_length, r.has_text) for r in rows if r.image_count is not None) == [
        ("Books", 0, 20, True), ("Toys_and_Games", 2, 9, True),
    ]
    assert [r.has_text for r in rows if r.image_count is None] == [False]


def test_malformed_and_oversized_records(spark, tmp_path):
    write(tmp_path / "C.jsonl", review(), '{"rating": 5, "title": "cut', review(text="x" * 2000), review(rating=1.0))
    folder = str(tmp_path)
    with pytest.raises(Exception, match="malformed review"):
        readers.read_reviews(spark, folder).collect()
    assert readers.read_reviews(spark, folder, bad_records="drop").count() == 3  # no bound on size unless asked for
    assert readers.read_reviews(spark, folder, bad_records="drop", max_chars=1000).count() == 2
    kept = readers.read_reviews(spark, folder, bad_records="keep", max_chars=1000)
    assert kept.where(F.col(readers.CORRUPT).isNotNull()).count() == 2 and kept.count() == 4
    lost = readers.count_bad(spark, folder, max_chars=1000).collect()
    assert [(r.file_name, r.lines, r.bad_lines) for r in lost] == [("C.jsonl", 4, 2)]


def test_listings_of_one_file_are_read_by_several_tasks(spark, tmp_path):
    head = "asin,title,imgUrl,productURL,stars,reviews,price,listPrice,category_id,isBestSeller,boughtInLastMonth\n"
    (tmp_path / "l.csv").write_text(head + "".join(f"a{i},T,i,u,4.5,10,9.99,19.98,1,True,50\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        df = readers.read_listings(spark, str(tmp_path / "l.csv"))
        assert df.rdd.getNumPartitions() > 3 and df.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_late_loads_add_and_reruns_do_not(spark, tmp_path):
    write(tmp_path / "A.jsonl", review(), review())
    write(tmp_path / "B.jsonl", review())
    out = str(tmp_path / "out")
    tables.append_reviews(readers.read_reviews(spark, str(tmp_path / "A.jsonl")), out, "one")
    for _ in range(2):
        tables.append_reviews(readers.read_reviews(spark, str(tmp_path / "B.jsonl")), out, "two")
    tables.append_reviews(readers.read_reviews(spark, str(tmp_path / "A.jsonl")), out, "three")
    got = {r.source_category: r["count"] for r in spark.read.parquet(out).groupBy("source_category").count().collect()}
    assert got == {"A": 4, "B": 1}


def test_files_arriving_later_are_loaded_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    args = (spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "state"))
    write(inbox / "A.jsonl", review(), review())
    refresh_reviews(*args)
    refresh_reviews(*args)
    write(inbox / "A.part2.jsonl", review(), "{broken")
    with pytest.raises(Exception, match="malformed review"):
        refresh_reviews(*args)
    refresh_reviews(*args, bad_records="drop")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3 and {r.source_category for r in got.collect()} == {"A"}


def test_tables_round_trip(spark, tmp_path, frame):
    folder = str(tmp_path / "gold")
    df = frame([(1, "a"), (2, "b")], "x int, y string")
    tables.export_gold({"one": df, "two": df.limit(1)}, folder)
    loaded = tables.load_tables(spark, folder)
    assert {n: d.count() for n, d in loaded.items()} == {"one": 2, "two": 1}
    assert spark.sql("SELECT count(*) AS n FROM one").first().n == 2
    again = tables.materialize(df.limit(1), str(tmp_path / "t"))
    assert tables.materialize(df, str(tmp_path / "t")).count() == 2 and again.columns == ["x", "y"]
    profile = tables.profile_files(loaded["one"]).agg(F.sum("rows").alias("r"), F.min("bytes").alias("b")).first()
    assert profile.r == 2 and profile.b > 0
    assert [r.column_name for r in tables.profile_schema(df).orderBy("position").collect()] == ["x", "y"]
    assert tables.bench_read(df).first().rows == 2


def test_shared_dir_is_the_one_the_session_names(spark):
    from mercata.session import scratch_path, shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert named and shared_dir(spark) == named
    assert scratch_path(spark, "x").startswith(named) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_raw_files_are_profiled_before_they_are_read(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n')
    (tmp_path / "open.csv").write_text('x,y\n1,"two\n')
    (tmp_path / "deep" / "b.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{"a": \n')
    (tmp_path / "none.json").write_text("")
    (tmp_path / "notes.TXT").write_text("text")
    with gzip.open(tmp_path / "c.jsonl.gz", "wt") as f:
        f.write('{"a": 3}\n')
    files = {r.file_name: (r.kind, r.bytes) for r in tables.raw_files(spark, str(tmp_path)).collect()}
    assert {n: k for n, (k, _) in files.items()} == {
        "a.csv": "csv", "open.csv": "csv", "b.jsonl": "json lines", "bad.jsonl": "json lines",
        "notes.TXT": "other", "c.jsonl.gz": "json lines",
    }
    assert files["a.csv"][1] == 18  # an empty file is not listed
    profile = {r.kind: (r.files, r.largest) for r in tables.raw_profile(spark, str(tmp_path)).collect()}
    assert profile["csv"] == (2, 18) and profile["json lines"][0] == 3 and profile["other"] == (1, 4)
    got = {r.file_name: (r.lines, r.bad_lines, r.readable) for r in tables.readable_files(spark, str(tmp_path)).collect()}
    assert got == {
        "a.csv": (3, 0, True), "open.csv": (2, 0, False), "b.jsonl": (3, 0, True), "bad.jsonl": (2, 1, False),
    }


def test_sorted_tables_are_read_in_part(spark, tmp_path):
    rows = spark.range(20_000).select(F.concat(F.lit("a"), "id").alias("asin"), F.concat(F.lit("s"), F.pmod("id", F.lit(50))).alias("sub"))
    df = tables.materialize(rows.repartition(4), str(tmp_path / "t"), sort_by=["sub"], look_up=["asin"])
    assert df.count() == 20_000
    holding = df.where("sub = 's7'").select(F.col("_metadata.file_name").alias("f")).distinct().count()
    assert holding == 1
    assert df.where("asin = 'a77'").count() == 1


def test_buckets_spare_the_shuffle_of_reviews(spark, tmp_path):
    rows = spark.range(3_000).select(
        F.concat(F.lit("P"), F.pmod("id", F.lit(40))).alias("parent_asin"), F.lit("Books").alias("source_category"),
        F.lit(1_600_000_000_000).alias("timestamp"), (F.pmod("id", F.lit(5)) + 1).cast("double").alias("rating"),
        F.concat(F.lit("u"), F.pmod("id", F.lit(99))).alias("user_id"), F.lit("t").alias("title"), F.lit("x").alias("text"), F.lit("A").alias("asin"),
        F.lit(0).cast("long").alias("helpful_vote"), F.lit(True).alias("verified_purchase"), F.lit(0).cast("long").alias("image_count"),
        F.lit(1).cast("long").alias("text_length"), *[F.lit(True).alias(c) for c in ("has_text", "has_title", "has_helpful_votes")],
    )
    dated = silver.reviews(rows)
    listed = spark.createDataFrame([(f"P{i}",) for i in range(30)], "asin string")
    first = tables.materialize_bucketed(dated, str(tmp_path / "t"), "bucketed_once", ["parent_asin"], 4)
    again = tables.open_bucketed(spark, str(tmp_path / "t"), "bucketed_again", first.schema, ["parent_asin"], 4)
    try:
        for reviews in (first, again):
            for make in (gold_reviews.product_review_summary, gold_reviews.product_review_trust):
                got, want = make(reviews, listed), make(dated, listed)
                plan = got._jdf.queryExecution().executedPlan().toString()
                scan = plan.index("bucketed_")
                aggregates = plan[:scan].split("HashAggregate")
                assert "Exchange hashpartitioning" not in aggregates[-1] and len(aggregates) > 2
                below = plan[plan.index("HashAggregate"):scan]
                assert "Exchange hashpartitioning(parent_asin" not in below
                assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
            trust, summary = gold_reviews.product_review_trust(reviews, listed), gold_reviews.product_review_summary(reviews, listed)
            assert gold_reviews.join_trust(trust, summary).count() == 30
    finally:
        for name in ("bucketed_once", "bucketed_again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
