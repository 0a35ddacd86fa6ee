"""monthgrid: monthly time-series pipelines as lazy Spark DataFrame transformations."""
