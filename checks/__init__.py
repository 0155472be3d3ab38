"""One registered query per operator on the given tables, with its SQL oracle."""

from checks.registry import ORACLES, QUERIES  # noqa: F401
from checks import (  # noqa: F401  isort: skip
    aggregates,
    cleaning,
    joins,
    jobs,
    pages,
    scalars,
    scores,
    sources,
    unions,
    windows,
)
