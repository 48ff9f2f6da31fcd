"""hosttel — host-telemetry analytics on Spark.

DataFrame in, DataFrame out. Every operator is a plain function over
``pyspark.sql.DataFrame`` that builds a lazy plan; nothing runs until the
caller triggers an action. Sub-packages:

* ``sources``   — fixed-schema readers (CSV, Kafka envelope, file streams),
                  sinks, and fixture views over the driver tables.
* ``functions`` — native column expressions (unit text, brackets, clock
                  text) and their SQL-callable registrations.
* ``operators`` — relational operators: cleaning, audit, profiling,
                  sampling, message framing, ordinals, metrics.
* ``plans``     — ML pipelines (index → encode → assemble → tree) and the
                  query catalogue used by ``__spark_entry__``.
* ``streaming`` — Structured Streaming jobs: decode, per-machine counts,
                  late/duplicate handling, trailing state, live scoring.
"""

__all__ = ["session"]
