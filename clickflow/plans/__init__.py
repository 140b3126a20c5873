"""Registered queries over the driver tables and their SQL oracles."""
from clickflow.plans.catalog import QUERIES, FLAGSHIP
from clickflow.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "FLAGSHIP", "ORACLE_SQL"]
