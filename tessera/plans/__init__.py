"""Query plans over the driver tables.

Importing this package registers every query in :data:`registry.REGISTRY`.
"""

from tessera.plans import q_profile, q_quality, q_reshape, q_series, q_stats, q_cluster, q_text, q_eval, q_stream, q_models, q_sources  # noqa: F401
from tessera.plans.registry import REGISTRY  # noqa: F401
