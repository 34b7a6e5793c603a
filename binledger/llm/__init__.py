"""Operators for training-data pipelines; nothing else in the library imports this package."""

from binledger.llm import (  # noqa: F401
    alignment, automaton, counts, decontaminate, forest, jaccard, licenses, merkle, pivots, preferences, rules, toxicity, warc,
)
from binledger.llm.registry import ORACLE, QUERIES  # noqa: F401
