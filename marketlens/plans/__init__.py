"""Named queries, each ``(spark, sf_dir) -> DataFrame``, and their equivalents in SQL where SQL can express them."""
