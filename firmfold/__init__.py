"""Business-record consolidation as Spark table-to-table jobs."""
