"""mercato: retail lakehouse analytics as plain PySpark DataFrame/SQL functions.

Layers: ``sources`` (bronze ingest, test-data adapter) -> ``plans.silver``
(clean, deduplicate, enrich, flag) -> ``plans.marts`` (gold analytical tables)
-> ``plans.scorecard`` / ``plans.quality`` (data-quality results as DataFrames)
-> ``plans.questions`` (business questions).  ``operators`` holds the reusable
scalable building blocks (deterministic dedup, distributed rank, guarded
broadcast, expectations); ``functions`` holds column expressions.
"""

__version__ = "0.1.0"
