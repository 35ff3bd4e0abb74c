"""Every operator as a query over the star tables."""

from keyloom.plans.star import aggregates, joins, loads, projections, scalars
from keyloom.plans.star.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "aggregates", "joins", "loads", "projections", "scalars"]
