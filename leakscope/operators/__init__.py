"""DataFrame -> DataFrame operators (the reference's work as Spark jobs)."""
