"""Market bar series on Spark: read, parse, resample, select and adjust."""
