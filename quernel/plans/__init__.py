"""Named queries: each takes (spark, directory of tables) and returns a DataFrame."""
