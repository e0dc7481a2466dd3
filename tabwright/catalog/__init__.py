"""All registered queries with their SQL twins."""

from . import association, drift, features, imputation, matrix, modelling, outliers, plans, profiling, scaling, sources_quality, splits_eval, streams  # noqa: F401
from .profiling import flagship  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
