"""Registered queries over the given tables, each with its SQL twin where there is one."""

from tunetable.plans import (  # noqa: F401
    alignment,
    datasets,
    evaluation,
    objectives,
    packing,
    preferences,
    rewards,
    rollouts,
    streams,
    templates,
    texts,
)
from tunetable.plans.registry import QUERIES, SQL  # noqa: F401
