"""Registered queries, each next to the SQL it is checked against."""
from gleaner.plans import cleaning, learning, located, profiling, texts, web  # noqa: F401
from gleaner.plans.registry import ORACLES, QUERIES  # noqa: F401
