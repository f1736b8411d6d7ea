"""All named queries, collected by importing the modules that define them."""

from queuecraft.plans import check_queries, feature_queries, model_queries, ranking_queries, report_queries, stream_queries, text_queries  # noqa: F401
from queuecraft.plans.registry import QUERIES, TWINS  # noqa: F401
