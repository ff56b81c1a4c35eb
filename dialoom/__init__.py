"""dialoom: dialogue fact analytics on Spark."""
