"""Text classification as DataFrame operators and Spark ML stages."""
