"""tamper: a Spark-native medallion pipeline and reporting library for order and
carbon-emission data.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so Catalyst can push filters and projections down to the scans and
keep the work inside whole-stage codegen. Storage, streaming and run logs live
in ``tamper.sources`` and ``tamper.streaming``.
"""

__all__ = ["schemas", "session"]
