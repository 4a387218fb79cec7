"""Daily-batch shop analytics as Spark DataFrame plans: clean, star schema, merge, KPIs."""
