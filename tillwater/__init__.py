"""Layered retail and social-media warehouse operators for Spark.

Every operator maps DataFrames to DataFrames with native column expressions:
no session, no clock and no fixed path inside.  Values that depend on "now" take
an ``as_of`` argument; values that were random draws are derived from a hash of
the row, so each run gives the same result.
"""

__version__ = "0.1.0"
