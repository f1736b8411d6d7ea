"""All queries of this subpackage, collected by importing the modules that define them."""

from queuecraft.llm import jaccard, merkle, negatives, packing, pieces, pii, quality, repeats, secrets, sharding, toxicity, vectors, wrappers  # noqa: F401
from queuecraft.llm.registry import QUERIES, TWINS  # noqa: F401
