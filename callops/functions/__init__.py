"""Column → Column rules, all built from Spark SQL functions."""
