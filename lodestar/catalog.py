"""The registered queries of the library and the DuckDB statement for each."""

from __future__ import annotations

from lodestar.plans.oracles import ORACLE_SQL
from lodestar.plans.queries import QUERIES

FLAGSHIP = "brand_knn_imputation"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
