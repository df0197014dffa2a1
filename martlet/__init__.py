"""martlet: ecommerce sales marts and a staged incremental load on PySpark.

Every public builder takes and returns DataFrames; nothing is computed until
an action runs, so Catalyst sees the whole plan (filters reach the Parquet
scans, unused columns are pruned, same-spec windows share one shuffle).
"""

from martlet.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
