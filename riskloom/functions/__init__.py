"""Column expressions: no function here sees a DataFrame or needs a shuffle."""
