"""Field-care visit analytics as plain Spark DataFrame jobs."""
