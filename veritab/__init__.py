"""veritab: table quality, drift and model-evaluation operators on Spark DataFrames.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and is built from Spark
expressions, so Catalyst plans it and the work is spread over the cluster.
"""

from veritab.roles import Roles
from veritab.session import get_session, checkpoint_dir

__all__ = ["Roles", "get_session", "checkpoint_dir"]
