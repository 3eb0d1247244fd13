"""Contact-centre analytics as set-based Spark jobs."""
