"""firn: consensus analytics over interval time series, written as Spark DataFrame transforms."""
