"""Whole analyses and the registered queries."""

from stayvalue.plans.customer_value import Settings, customer_table, run, stays_table

__all__ = ["Settings", "customer_table", "run", "stays_table"]
