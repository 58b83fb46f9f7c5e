"""riskweave: a Spark-native claims analytics library.

Every operator is a function ``DataFrame(s) + parameters -> DataFrame``
built from Spark SQL / DataFrame expressions, so Catalyst plans, prunes
and pushes down across operator boundaries.  Sub-packages:

* ``sources``   -- raw inputs (fixture views, CSV/Parquet readers, table writers)
* ``functions`` -- column expressions (calendar, risk banding, money sums)
* ``operators`` -- cleansing, enrichment, gold aggregates, scoring, windows,
                   data-quality expectations, sampling, ML
* ``plans``     -- the medallion batch and the registry of named queries
* ``streaming`` -- the stateless layers applied to a file stream
"""

from riskweave.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
