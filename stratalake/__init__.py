"""stratalake -- PySpark-native toolkit for layered (bronze/silver/gold) data lakes.

Subpackages:

* ``functions``  Column -> Column expressions (label cleaning, coordinate repair)
* ``operators``  DataFrame -> DataFrame operators (repair, roll-up, data quality)
* ``sources``    schemas, dated JSON snapshots, paged sources, table sinks
* ``plans``      the bronze / silver / gold stages
* ``streaming``  incremental processing of new snapshots with Structured Streaming

Everything runs on the caller's SparkSession; nothing creates or stops one.
"""

__version__ = "0.1.0"
