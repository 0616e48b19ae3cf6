"""Social post analytics on Spark: clean, join, count, rank and take medians over posts, places and users."""
