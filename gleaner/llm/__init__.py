"""Operators for preparing language-model training data, with their queries and SQL."""

from gleaner.llm.queries import ORACLES, QUERIES  # noqa: F401
