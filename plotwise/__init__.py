"""Property-listing pipelines as Spark jobs: extract, clean, merge, measure."""
