"""Queries over the driver tables, one or more per operator, with SQL twins."""

from tessera.plans import (aggregates, dml, etl, filters, joins, multisets, scalars, search,  # noqa: F401
                           sequences, windows)
from tessera.plans import streams  # noqa: F401  (reuses twins of the others)
from tessera.plans.registry import OPERATORS, ORACLES, QUERIES  # noqa: F401
