"""aurum: a Spark-native medallion toolkit for multi-site clinical and imaging data.

Layers are plain ``DataFrame -> DataFrame`` functions:

* ``aurum.sources``   – CSV ingest with corrupt-row capture, landing-zone scans
* ``aurum.operators`` – cleaning, harmonisation, dedup, joins, de-identification, stats
* ``aurum.sinks``     – partitioned Parquet/table writers
* ``aurum.plans``     – Bronze/Silver/Gold compositions, the run driver, lineage
* ``aurum.streaming`` – incremental (exactly-once) landing ingest
"""

__version__ = "0.1.0"
