"""Trade quality, exposure and lineage as Spark DataFrame operations."""
