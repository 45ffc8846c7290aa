"""Market tick analytics on Spark: windows, alerts, views and serving queries."""
