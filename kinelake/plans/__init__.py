"""Queries over the tables of a data folder."""

from kinelake.plans import analytics, chain, dataprep, more, prompts, scans, tokens, transforms
from kinelake.plans.registry import core

__all__ = ["analytics", "chain", "core", "dataprep", "more", "prompts", "scans", "tokens", "transforms"]
