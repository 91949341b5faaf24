"""citeflow: reference verification and corpus preparation as Spark jobs."""
