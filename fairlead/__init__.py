"""fairlead - vessel-movement analytics as plain Spark DataFrame functions."""
