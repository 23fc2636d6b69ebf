"""feedlens: feed-article analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function, so jobs compose with ``DataFrame.transform`` and Catalyst sees one
logical plan from the Parquet scan to the rendered text.
"""

__all__ = ["session", "schema", "functions", "operators", "sources", "plans", "streaming"]
