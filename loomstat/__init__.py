"""Applied analytics as Spark jobs: DataFrames in, DataFrames out."""
