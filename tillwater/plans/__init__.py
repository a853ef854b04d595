"""Pipelines: loads, silver and gold retail tables, sales, calendar, social, marketplace."""
