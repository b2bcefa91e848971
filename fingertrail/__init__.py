"""Quality engine for touch-interaction event logs, expressed as Spark DataFrame jobs."""
