"""All registered queries."""

from driftline.plans import (  # noqa: F401
    queries_claims, queries_flows, queries_graph, queries_review, queries_rules, queries_streams, queries_trace)
from driftline.plans.registry import ORACLES, QUERIES  # noqa: F401
