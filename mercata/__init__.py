"""Marketplace analytics on Spark DataFrames.

Layers: ``sources`` read and flag the raw files, ``plans.silver`` enriches
them, ``plans.gold_*`` aggregate them, ``plans.analysis`` and
``plans.serving`` answer questions over the aggregates, ``ml`` trains and
applies models.  Every operator is a function from DataFrame to DataFrame.
"""

from mercata.market import Market

__all__ = ["Market"]
