"""vitrina: a Spark-native shop-warehouse ETL and analytics library.

Sources -> cleaning -> merges (upsert, insert-if-absent, SCD type 2) ->
dimensions and facts -> KPIs and views, all as DataFrame -> DataFrame
functions over built-in Spark expressions.
"""

__version__ = "0.1.0"
