"""zonelake: a PySpark library for a three-zone JSON event lake.

Raw JSON envelopes are classified and landed (``operators.ingest``), checked
against per-source payload schemas (``operators.validate``), cleaned,
fingerprinted and deduplicated into partitioned Parquet
(``operators.process``), aggregated into daily, hourly and per-source tables
(``operators.curate``) and queried (``plans.queries``).

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark column expressions, so it runs on the executors inside whole-stage
code generation; nothing is collected to the driver.
"""

__version__ = "0.1.0"
