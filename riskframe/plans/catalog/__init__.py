"""The registered queries, one module per area, each with its ANSI-SQL equivalent where SQL can express it."""

from riskframe.plans.catalog import (  # noqa: F401
    cleaning,
    evaluation,
    exploration,
    fusing,
    integration,
    laboratory,
    learning,
    scoring,
    splitting,
    storage,
    texts,
)
from riskframe.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
