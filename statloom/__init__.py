"""statloom: DataFrame operators and plans for official economic statistics."""
