"""fieldstat — per-entity event analytics and model evaluation on Spark.

Every operator takes and returns a ``pyspark.sql.DataFrame``; nothing is
collected to the driver except results that are small by construction
(parameter grids, pivots, bucket boundaries).
"""

from fieldstat.session import get_session, materialise, shared_dir

__all__ = ["get_session", "materialise", "shared_dir"]
