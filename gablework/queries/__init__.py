"""All registered queries."""

from gablework.queries import tables, profiling, preparation, modelling  # noqa: F401, I001
from gablework.queries.registry import ORACLES, QUERIES  # noqa: F401
