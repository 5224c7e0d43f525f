"""tidemark: point-in-time time-series analytics on PySpark.

A *panel* is a DataFrame ``(series_id STRING, date DATE, value DOUBLE)`` with
at most one row per key and day.  Missing values are NULL, never NaN.

Because dates are day stamps, a series in panel form holds at most one row per
calendar day (about 37,000 rows per century) however many raw records fed it.
Operators that need a per-series window rely on that bound; whatever can be
larger (raw records, vintages, fact tables) is aggregated or split first.
"""

__version__ = "0.1.0"
