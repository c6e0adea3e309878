"""Daily warehouse loads as Spark DataFrame programs."""
