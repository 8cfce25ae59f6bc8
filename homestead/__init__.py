"""homestead — a Spark-native listings lakehouse.

Raw pages and JSON documents become a typed, date-partitioned silver table,
then a keyed gold fact table (insert-ignore / upsert), and finally
market-report marts. Every operator is ``f(df, ...) -> DataFrame`` built from
Spark's own DataFrame API. Jobs run in the explicit ``write_*`` / ``run_*``
entry points, in exact quantiles (which checkpoint their value table) and where
a learned operator of ``llm`` fits its model.
"""

__version__ = "0.1.0"
