"""Field-survey catch data on Spark: cleaning, keys, catch totals, effort and quality checks."""
