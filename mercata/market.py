"""A marketplace: the flagged inputs and every table derived from them, lazily."""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from mercata.plans import gold_products, gold_reviews, silver


# How written tables lie: rows of a subcategory together, since dashboards ask for one, and single products quick to find.
LAYOUT = {"products": {"sort_by": ["subcategory"], "look_up": ["asin"]}}


class Market:
    """Names for the tables of the pipeline; each is a lazy DataFrame until written.

    ``tables`` holds what is already there: flagged inputs (``listings``,
    ``categories``, ``metadata``, ``reviews``; or functions that give them) and any
    derived table that was materialised before, which is then read instead of
    being worked out again.  ``review_facts`` may be given beside the reviews where these
    cost less without titles and texts.
    """

    DERIVED = (
        "products", "category_profile", "stores",
        "subcategory_landscape", "main_category_landscape", "price_positioning", "brand_dynamics",
        "discount_effectiveness", "listing_quality", "bestseller_analysis", "product_benchmarks",
        "product_review_summary", "product_review_trust", "category_benchmarks_full",
        "store_performance", "review_trust", "review_sentiment", "temporal_trends",
        "review_keywords", "product_clusters", "product_trust_scores",
    )

    INPUTS = ("listings", "categories", "metadata", "reviews")
    SPARED = ("review_facts",)  # may be left out

    def __init__(
        self, recent_since: str = "2022-01-01", trend_years=(2000, 2025),
        keyword_min_count: int = 50, keyword_sample_pct: float = 100.0, **tables,
    ):
        self.recent_since = recent_since
        self.trend_years = trend_years
        self.keyword_min_count = keyword_min_count
        self.keyword_sample_pct = keyword_sample_pct
        self.inputs = {name: tables.pop(name) for name in (*self.INPUTS, *self.SPARED) if name in tables}
        self.__dict__.update(tables)  # what is already there replaces its definition

    def _input(self, name: str) -> DataFrame:
        given = self.inputs[name]
        return given() if callable(given) else given

    @cached_property
    def listings(self) -> DataFrame:
        return self._input("listings")

    @cached_property
    def categories(self) -> DataFrame:
        return self._input("categories")

    @cached_property
    def metadata(self) -> DataFrame:
        return self._input("metadata")

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return self._input("reviews")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, **options) -> "Market":
        """A market over tables written earlier by :meth:`write`."""
        from mercata.sources.tables import load_tables

        return cls(**load_tables(spark, folder, register=False), **options)

    def write(self, folder: str, names: list[str]) -> None:
        """Materialise tables one after another; later ones read the earlier."""
        from mercata.sources.tables import materialize

        for name in names:
            df = materialize(getattr(self, name), os.path.join(folder, name), **LAYOUT.get(name, {}))
            self.__dict__[name] = df
            if name in ("raw_reviews", "reviews"):  # their facts come from what is written, too
                self.inputs.pop("review_facts", None)

    # ---- silver
    @cached_property
    def products(self) -> DataFrame:
        return silver.products(self.listings, self.categories, self.metadata)

    @cached_property
    def products_full(self) -> DataFrame:
        return silver.products_full(self.metadata)

    @cached_property
    def category_profile(self) -> DataFrame:
        return silver.category_profile(self.products_full)

    @cached_property
    def stores(self) -> DataFrame:
        return silver.stores(self.products_full)

    @cached_property
    def reviews(self) -> DataFrame:
        return silver.reviews(self.raw_reviews)

    @cached_property
    def review_facts(self) -> DataFrame:
        """Of the reviews what is counted per product; written, it is read instead of the reviews, once for each table."""
        return silver.review_facts(self._input("review_facts") if "review_facts" in self.inputs else self.reviews)

    # ---- gold, listings
    @cached_property
    def subcategory_landscape(self) -> DataFrame:
        return gold_products.subcategory_landscape(self.products)

    @cached_property
    def main_category_landscape(self) -> DataFrame:
        return gold_products.main_category_landscape(self.category_profile, self.products)

    @cached_property
    def price_positioning(self) -> DataFrame:
        return gold_products.price_positioning(self.products)

    @cached_property
    def brand_dynamics(self) -> DataFrame:
        return gold_products.brand_dynamics(self.products)

    @cached_property
    def discount_effectiveness(self) -> DataFrame:
        return gold_products.discount_effectiveness(self.products)

    @cached_property
    def listing_quality(self) -> DataFrame:
        return gold_products.listing_quality(self.products)

    @cached_property
    def bestseller_analysis(self) -> DataFrame:
        return gold_products.bestseller_analysis(self.products)

    @cached_property
    def product_benchmarks(self) -> DataFrame:
        return gold_products.product_benchmarks(self.products)

    @cached_property
    def category_benchmarks_full(self) -> DataFrame:
        return gold_products.category_benchmarks_full(self.products, self.product_review_summary)

    @cached_property
    def store_performance(self) -> DataFrame:
        return gold_products.store_performance(self.stores, self.products)

    # ---- gold, reviews
    @cached_property
    def product_review_summary(self) -> DataFrame:
        return gold_reviews.product_review_summary(self.review_facts, self.listings, self.recent_since)

    @cached_property
    def product_review_trust(self) -> DataFrame:
        return gold_reviews.product_review_trust(self.review_facts, self.listings)

    @cached_property
    def review_trust(self) -> DataFrame:
        return gold_reviews.review_trust(self.reviews)

    @cached_property
    def review_sentiment(self) -> DataFrame:
        return gold_reviews.review_sentiment(self.reviews)

    @cached_property
    def temporal_trends(self) -> DataFrame:
        return gold_reviews.temporal_trends(self.reviews, *self.trend_years)

    @cached_property
    def review_keywords(self) -> DataFrame:
        return gold_reviews.review_keywords(
            self.reviews, min_count=self.keyword_min_count, sample_pct=self.keyword_sample_pct
        )

    # ---- models
    @cached_property
    def product_clusters(self) -> DataFrame:
        from mercata.ml.clusters import product_clusters

        return product_clusters(self.products)

    @cached_property
    def product_trust_scores(self) -> DataFrame:
        from mercata.ml.anomalies import product_trust_scores

        return product_trust_scores(self.product_review_trust, self.product_review_summary)
