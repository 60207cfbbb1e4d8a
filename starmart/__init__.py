"""Star-schema marts on Spark: sources, cleaning, dimensions, facts, loads, checks."""
