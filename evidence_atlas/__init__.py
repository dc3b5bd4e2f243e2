"""PySpark operators for evidence-backed place-name tables."""
