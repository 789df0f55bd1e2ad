"""tabula: business-analytics operators on Spark DataFrames.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and
is built from Catalyst expressions (no Python UDFs), so plans stay inside
whole-stage codegen and scale with the cluster.
"""

from tabula.session import build_session, checkpoint_dir  # noqa: F401
