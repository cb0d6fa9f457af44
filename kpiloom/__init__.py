"""Product analytics for subscription learning products, as Spark jobs."""
