"""quarry: relational, document, graph and change-set operators as Spark jobs.

Every operator is a function from DataFrames to a DataFrame. The heavy work
(scans, joins, shuffles, windows) runs on Spark; nothing is collected to the
driver except bounded per-partition summaries.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers that run
    the pandas-backed operators do not need ``quarry`` on their path."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
