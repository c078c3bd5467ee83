"""ceasekit: subscriber-attrition analytics as plain Spark DataFrame jobs.

Every public operator takes DataFrames (and a :class:`ChurnConfig`) and
returns a DataFrame; the work stays on the cluster.  Sub-packages:

* ``sources``   – reading, landing and exporting tables, derived test tables
* ``functions`` – column expressions (dates, sampling keys, buckets, names)
* ``operators`` – reusable relational building blocks (dedup, quantiles, ...)
* ``plans``     – the composite jobs: quality, observation set, features,
  profiles, model training and evaluation, the medallion pipeline
* ``streaming`` – incremental landing of raw files into bronze tables
"""

from ceasekit.config import ChurnConfig
from ceasekit.session import get_spark

__all__ = ["ChurnConfig", "get_spark"]
