"""Question-and-answer dumps to point-in-time features, models and scores, on Spark."""
