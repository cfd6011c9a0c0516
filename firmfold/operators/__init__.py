"""Table-to-table operators: DataFrame -> DataFrame, no actions inside."""
