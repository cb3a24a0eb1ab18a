"""lodestar: batch analytics on Spark DataFrames.

Three workload families, each a set of functions that take and return
DataFrames:

* clustering of numeric points (MLlib k-means and a deterministic Lloyd
  iteration written as column expressions),
* tree-ensemble classification (derive, filter, standardize, split, train,
  score, evaluate),
* triangle counting on an undirected graph (per vertex and total).

Sub-packages:

* ``sources``   -- readers, writers and the seeded point generator
* ``functions`` -- column-expression helpers (distances, hash buckets, ...)
* ``operators`` -- the operators themselves
* ``plans``     -- end-to-end jobs, the phase report and the query catalog
"""

from lodestar.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
