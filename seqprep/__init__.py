"""Training-data preparation and training-run reporting as Spark jobs."""
