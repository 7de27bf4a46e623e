"""All registered queries, by name, with their SQL counterparts."""

from starmill.queries import chunks, cleaning, loads, reports, sinks, stars, streams  # noqa: F401
from starmill.queries.base import REGISTRY

QUERIES = REGISTRY.queries
ORACLES = REGISTRY.oracles
