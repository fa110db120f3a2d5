"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The pipeline runs the way it is meant to: flagged inputs are written once,
silver and gold are built from them, reports read gold.  The first pass warms
the JVM; the second, over fresh files, is timed.  Models are fitted in the second
pass only.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercata import roles
from mercata.market import Market
from mercata.ml import anomalies, attributions, clusters, success
from mercata.plans import analysis as A
from mercata.plans import gold_products as gp
from mercata.plans import gold_reviews as gr
from mercata.plans import serving
from mercata.session import build_session, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
INPUTS = ["listings", "categories", "metadata", "raw_reviews"]
TABLES = [
    "products", "category_profile", "stores", "subcategory_landscape", "main_category_landscape",
    "price_positioning", "brand_dynamics", "discount_effectiveness", "listing_quality",
    "bestseller_analysis", "product_benchmarks", "product_review_summary", "product_review_trust",
    "category_benchmarks_full", "store_performance", "review_trust", "review_sentiment",
    "temporal_trends", "review_keywords",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def reports(m: Market) -> dict:
    lo, hi = roles.WINDOW
    return {
        "brand_multiplier": lambda: gp.brand_multiplier_top(m.brand_dynamics),
        "opportunity_score": lambda: A.opportunity_score(m.subcategory_landscape),
        "category_typology": lambda: A.category_typology(m.subcategory_landscape),
        "yearly_trend": lambda: A.yearly_trend(m.temporal_trends, lo, hi),
        "yoy_growth": lambda: A.yoy_growth(m.temporal_trends, lo, hi),
        "tier_share": lambda: A.tier_share(m.price_positioning, "price_tier"),
        "concentration": lambda: A.concentration(m.store_performance),
        "distinctive_keywords": lambda: gr.distinctive_keywords(m.review_keywords),
        "health_position": lambda: serving.health_position(m, ["102"]),
        "cluster_features": lambda: clusters.cluster_features(m.products),
        "trust_features": lambda: anomalies.trust_features(m.product_review_trust, m.product_review_summary),
        "trust_scores": lambda: anomalies.product_trust_scores(m.product_review_trust, m.product_review_summary),
    }


def models(m: Market) -> dict:
    """Models with the library's own settings; attributions of every listing that was split."""
    made = {}

    def train():
        made["split"] = success.stratified_split(clusters.checkpointed(success.success_features(m.products)))
        made["model"] = success.train_success(made["split"])

    return {
        "choose_k": lambda: drain(clusters.choose_k(clusters.cluster_features(m.products))),
        "archetypes": lambda: drain(m.product_clusters),
        "success_model": train,
        "attributions": lambda: drain(attributions.explain(made["model"], made["split"].limit(20_000).repartition(int(CPUS)))),
    }


def run(spark, folder: str, with_models: bool) -> dict[str, float]:
    times: dict[str, float] = {}
    m = roles.market(spark, SF_DIR)

    def timed(name, action):
        start = time.time()
        action()
        times[name] = round(time.time() - start, 3)

    for name in INPUTS + TABLES:
        timed(name, lambda: m.write(folder, [name]))
    for name, make in reports(m).items():
        timed(name, lambda: drain(make()))
    for name, action in models(m).items() if with_models else ():
        timed(name, action)
    return times


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, scratch_path(spark, "bench"), False)
    times = run(spark, scratch_path(spark, "bench"), True)
    print(json.dumps({
        "metric": "marketplace pipeline and reports", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
