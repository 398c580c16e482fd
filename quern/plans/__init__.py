"""All jobs; importing the package fills the registry."""

from quern.plans import basics, evaluation, linear, models, ratings, series, streams, texts, trees  # noqa: F401
from quern.plans.registry import JOBS, TWINS

__all__ = ["JOBS", "TWINS"]
