"""All query modules, loaded."""

from papyrine.plans import classes, corpus, evaluations, files, links, sections, texts, vectors  # noqa: F401
from papyrine.plans.registry import ORACLES, QUERIES  # noqa: F401
