"""Query plans over the driver's test tables, one per SURVEY key.

Importing this package registers every plan; ``registry.QUERIES`` maps a key
to ``fn(spark, sf_dir) -> DataFrame`` and ``registry.ORACLE`` maps the same
key to equivalent DuckDB SQL where one exists.
"""

from rampart.plans import registry  # noqa: F401
from rampart.plans import policy_plans, gate_plans, matching_plans, event_plans, run_plans, report_plans, transform_plans, text_plans, stream_plans  # noqa: F401

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
