"""All registered queries."""

from . import cleaning, closed_forms, describing, evaluating, modelling, neighbouring, neighbouring_large, preparing, searching, starting  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
