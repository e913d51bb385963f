"""Commuting and sport-activity benefits, computed with Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame built from Spark's own
functions, so Catalyst sees the whole plan. Sub-packages:

``functions``  column expressions (dates, text, geography, wire decoding)
``operators``  DataFrame transforms (facts, de-duplication, upsert, quality, monitoring)
``sources``    readers (Parquet, CSV, topics, JDBC, file inventory)
``sinks``      writers (Parquet zones, snapshot tables, JDBC)
``streaming``  Structured Streaming jobs
``plans``      the end-to-end loads built from the parts above
"""
