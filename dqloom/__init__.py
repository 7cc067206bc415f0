"""dqloom: declaration cleaning, validation and quality reporting on Spark."""
