"""aeris: air-quality analytics expressed as Spark DataFrame / SQL / Structured Streaming jobs.

Layout
------
functions/  column expressions (parsing, codes, thresholds, index, geo, display, text)
sources/    readers and writers (CSV, Bronze JSON, Parquet marts, JDBC, documents, binding)
operators/  DataFrame -> DataFrame operators (silver, gold, stations, serving, analytics, quality)
plans/      end-to-end jobs and the query catalog used by ``__spark_entry__``
streaming/  Kafka-style publishing and the checkpointed Bronze file sink
"""

__version__ = "0.1.0"
