"""Price-bar features, scoring and evaluation as Spark DataFrame programs."""
