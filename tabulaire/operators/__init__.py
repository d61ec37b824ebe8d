"""Operators on sample-by-feature tables: scalers, row norms, sample filters, feature matrices."""

from .design import extract_features, feature_listing, select_features
from .normalizers import normalize
from .scalers import MaxAbs, MinMax, Robust, Standard, standardize
from .selection import FILTERS, complete_cases, missing_by_column, sample_counts

__all__ = ["FILTERS", "MaxAbs", "MinMax", "Robust", "Standard", "complete_cases", "extract_features", "feature_listing", "missing_by_column", "normalize", "sample_counts", "select_features", "standardize"]
