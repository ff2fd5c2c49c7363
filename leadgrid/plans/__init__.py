"""Registered queries: each runs an operator over whole tables, most with an SQL twin."""

from leadgrid.plans import (  # noqa: F401
    q_contacts,
    q_delivery,
    q_entity,
    q_lists,
    q_pages,
    q_rules,
    q_signals,
    q_stream,
    q_text,
    q_validate,
)
from leadgrid.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
