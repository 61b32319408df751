"""All registered queries: importing this module fills the registry."""

from pressloom.plans import q_scalar, q_links, q_articles, q_rules, q_feeds, q_jobs, q_stream  # noqa: F401
from pressloom.plans.registry import ORACLES, QUERIES  # noqa: F401
