"""Reading and writing tables, views, models, metrics and intermediate results."""
