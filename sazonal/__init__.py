"""Daily case-forecasting datasets and models as Spark DataFrame jobs."""
