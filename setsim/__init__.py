"""setsim: set-fingerprint similarity search and a small star-schema mart on Spark.

Layout
------
``sources``    scans of release extracts and readers/writers of the outputs
``functions``  Column-level helpers (blank/NaN to NULL, strict casts, hashing, Tanimoto)
``operators``  DataFrame operators: conform, quality checks, fingerprints,
               similarity search, mart and views
``plans``      end-to-end refresh, the query catalogue and its SQL oracles
"""

from setsim.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
