"""Reusable DataFrame operators that refine raw tables, nested documents and
database snapshots through bronze, silver and gold layers on Spark."""
