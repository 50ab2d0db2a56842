"""Query catalogue: one Spark plan per inventory operator and its SQL twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB
SQL over the driver's views) produce the same columns. Double columns are
rounded to 6 digits on both sides. Importing this module registers every
query module.
"""

from tspanel.plans import q_pipeline  # noqa: F401
from tspanel.plans import q_prepare  # noqa: F401
from tspanel.plans import q_features  # noqa: F401
from tspanel.plans import q_stats  # noqa: F401
from tspanel.plans import q_models  # noqa: F401
from tspanel.plans import q_fleet  # noqa: F401
from tspanel.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
