"""flightlake — flight-delay analytics as Spark jobs.

Layers (all plain DataFrame / Spark SQL):

* ``sources``   — bronze readers (CSV, JSON envelopes), landing and table sinks,
                  surrogate bronze frames derived from the driver's tables.
* ``functions`` — ANSI-safe column expressions and aggregate helpers.
* ``operators`` — silver cleaning, deterministic dedupe, gold aggregates, the
                  flight/weather join.
* ``plans``     — business reports, job runner with audit, catalog views.
* ``streaming`` — incremental bronze→silver ingestion with Structured Streaming.
"""

__all__ = ["session"]
