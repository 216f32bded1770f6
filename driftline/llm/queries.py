"""Importing this module registers every query of the subpackage."""

from driftline.llm import aligning, chat, languages, maxent, mixing, near_texts, near_vectors, periodic, quality, secrets, token_files, token_links, urls  # noqa: F401
from driftline.llm.registry import ORACLES, QUERIES  # noqa: F401
