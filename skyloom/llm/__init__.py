"""Operators for training-data corpora. Nothing else in the library imports this package."""

from skyloom.llm import exact, leaks, licences, near, packing, ranking, repeats, secrets, simhash, tokenfiles, toxicity, urls, whitening  # noqa: F401  (registration happens on import)
from skyloom.llm.common import ORACLES, QUERIES  # noqa: F401
