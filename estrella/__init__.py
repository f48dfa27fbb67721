"""estrella: star-schema marts, reconciliations and data-quality audits as Spark jobs.

Layers mirror a classic warehouse build:

* ``sources``   - explicit-schema readers (Parquet tables, CSV lookups) and sinks
  (views, overwritten tables, layer routing).
* ``functions`` - Column -> Column helpers: text cleaning, null tokens, safe casts,
  label normalisation, encoding repair, surrogate / natural keys, date parts.
* ``operators`` - DataFrame -> DataFrame building blocks: survivor dedup,
  pre-aggregate-then-join, coverage, reconciliation, calendar, quality checks.
* ``plans``     - the staged pipelines (staging -> warehouse -> marts -> audits)
  expressed over the driver's test tables, one builder per query key.

Everything is a lazy DataFrame plan; Catalyst and AQE choose the physical strategy.
"""

__version__ = "0.1.0"
