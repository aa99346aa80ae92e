"""aerostat — a Spark-native engine for daily flight-and-weather style feeds.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built on Spark SQL built-ins, with column names as parameters so
the same operator runs on the real feeds and on the TPC-H-like test tables.

Layout:
    sources/    JSON feed readers, Parquet/table scans, response envelopes
    functions/  scalar expressions (lenient JSON paths, floats, dates, lookup)
    operators/  flatten, filters, joins, aggregates, top-k, set ops, sinks
    plans/      end-to-end jobs: daily transform, serving load, ad-hoc, dashboard
"""

__version__ = "0.1.0"
