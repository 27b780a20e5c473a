"""Imports every query module so that the registry is complete."""

from riskline.plans import profile_queries  # noqa: F401
from riskline.plans import describe_queries  # noqa: F401
from riskline.plans import stats_queries  # noqa: F401
from riskline.plans import sampling_queries  # noqa: F401
from riskline.plans import metrics_queries  # noqa: F401
from riskline.plans import neighbor_queries  # noqa: F401
from riskline.plans import model_queries  # noqa: F401
from riskline.plans import clean_queries  # noqa: F401
from riskline.plans import extra_fixture_queries  # noqa: F401
from riskline.plans import degenerate_queries  # noqa: F401
from riskline.plans import state_queries  # noqa: F401
