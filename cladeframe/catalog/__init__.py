"""The registered queries: every operator bound to the given tables, with the SQL
that checks it."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import files, genes, search, traits, trees  # noqa: F401,E402
