"""Feature tables, MLlib models and their metrics."""
