"""Queries over the given tables, each with a SQL twin where SQL can say it."""

from orderloom.workload import q_customers, q_models, q_rules, q_sales, q_star, q_statistics  # noqa: F401
