"""sparktally: ratings and review-text analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame built from built-in
Spark functions, so Catalyst plans it and Tungsten runs it; nothing is
collected to the driver.

Sub-packages:

- ``functions``  column expressions (text cleaning, safe casts, bands, rendering)
- ``sources``    readers for delimited text inputs and the parquet test tables
- ``sinks``      text / CSV writers and previews
- ``operators``  joins, rating aggregates, text tokenising, counts and top-k
- ``plans``      the named queries over the test tables and their SQL oracles
- ``streaming``  the count operators over a growing folder
"""

from sparktally.session import checkpoint_dir, get_session

__all__ = ["checkpoint_dir", "get_session"]
