"""terrane — Spark-native property-transaction analytics.

Layers: ``sources`` (manifests, archives, delimited files, seeds),
``operators`` (clean, window, aggregate, join, quality, upsert),
``functions`` (column helpers and exact measures), ``plans`` (silver, gold,
star datasets) and ``streaming`` (the file-load ledger).

Main entry points::

    from terrane import run_refresh, silver_rows, datasets, build_model, run_checks
"""

__version__ = "0.1.0"

__all__ = ["build_model", "datasets", "incremental_build", "run_checks", "run_refresh", "silver_rows", "summarize"]


def __getattr__(name):  # lazy: importing the package does not start planning anything
    if name in ("silver_rows", "incremental_build"):
        from .plans import silver
        return getattr(silver, name)
    if name in ("build_model", "run_refresh"):
        from .plans import runner
        return getattr(runner, name)
    if name == "datasets":
        from .plans.model import datasets
        return datasets
    if name in ("run_checks", "summarize"):
        from .operators import quality
        return getattr(quality, name)
    raise AttributeError(name)
