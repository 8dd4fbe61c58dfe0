"""staywise: a Spark-native booking analytics library.

Bronze ingest, silver cleaning/enrichment, a gold star schema with revenue
KPIs, data-quality checks and report queries, all expressed as
``DataFrame -> DataFrame`` functions over Spark built-ins.
"""

__version__ = "0.1.0"
