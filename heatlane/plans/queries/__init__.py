"""Importing this package registers every query."""

from heatlane.plans.queries import files, groups, history, models, pages, priors, roundtrips, streams, texts  # noqa: F401
from heatlane.plans.registry import ORACLES, QUERIES  # noqa: F401
