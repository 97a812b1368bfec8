"""interlens: user-item interaction analytics and recommender evaluation on Spark.

Modules
-------
sources      readers / writers (CSV, JSON lines, Parquet), schemas, interaction views
functions    seeded portable hash buckets
operators    filters, sampling, splits, positions, set operations, index, top-k, metrics
plans        baseline predictors, ALS training and tuning, the registered query catalog
streaming    empty: the workload is batch only

Every operator takes and returns DataFrames; nothing but scalars and
bounded tables (one row per partition, per fold or per grid point) reaches
the driver.
"""

__version__ = "0.1.0"
