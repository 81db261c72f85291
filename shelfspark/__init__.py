"""Out-of-stock model operations on retail stock panels, as Spark DataFrame operators and jobs."""
