"""Business-table analytics on Spark: cleaning, scoring, KPIs, auditing, trends and trip profiles.

Every operator takes and returns a ``DataFrame`` (or a ``Column``). Operators are lazy except where a table
has to be fixed before it is used several times; then it is written, or a single row is read.
"""

__version__ = "0.1.0"
