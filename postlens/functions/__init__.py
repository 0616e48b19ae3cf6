"""Column expressions. All are built-in Spark expressions and work on batch and streaming frames alike."""
