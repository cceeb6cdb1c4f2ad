"""Sales-by-weather analytics and sparse-record risk scoring, as Spark DataFrame operators."""
