"""Relational operator showcases (joins, filters, aggregates, windows, sets)."""

from shelfline.operators import aggregates, asof, joins, predicates, setops, windows  # noqa: F401
from shelfline.functions import scalar  # noqa: F401
