"""speechprep: Spark-native operators for preparing speech datasets.

Every operator takes and returns DataFrames; the heavy lifting stays in
Catalyst / Tungsten (built-in expressions, windows, joins, aggregates),
with Arrow-batched pandas functions only for ordered per-key folds and
user model calls.
"""

__version__ = "0.1.0"
