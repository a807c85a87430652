"""scoutlens: analytics over match statistics (cleaning, dated targets, peer z-scores,
scoring, clustering and serving queries) as Spark DataFrame operators."""

__version__ = "0.1.0"
