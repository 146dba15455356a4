"""fieldmart: agricultural market, weather and crop analytics as Spark jobs."""
