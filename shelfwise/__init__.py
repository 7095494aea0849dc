"""shelfwise: warehouse-equipment inventory marts as Spark DataFrame plans.

Layers: raw CSV -> conformed (dds) Parquet -> marts (dm) Parquet/CSV ->
warehouse tables.  Subpackages:

* ``sources``   -- CSV scans, landing, source probes, driver-table adapters
* ``functions`` -- column-level scalars (dates, conditional counts, try-casts)
* ``operators`` -- joins, aggregates, conform, data rules
* ``plans``     -- the five marts, the end-to-end pipeline, the query registry
* ``sinks``     -- Parquet/CSV dataset writes, warehouse and JDBC loads
* ``streaming`` -- intentionally empty: the workload is a daily batch
"""

from .vocab import ADAPTER_VOCAB, SOURCE_VOCAB, Vocabulary  # noqa: F401

__all__ = ["ADAPTER_VOCAB", "SOURCE_VOCAB", "Vocabulary"]
