"""sparkmart: retail ELT and dimensional analytics on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame or from Column to Column.

* ``functions``  column builders: casts, text, keys, dates, measures
* ``operators``  relational operators: lookup, dedup, upsert, SCD2, quality
* ``sources``    landed pages, control table, JDBC, tables
* ``plans``      staging models, dimensions, facts, reports, the warehouse build
* ``streaming``  incremental ingest of landed pages
"""
