"""Property-listing analytics on Spark: landing, cleaning, star schema, load, queries."""
