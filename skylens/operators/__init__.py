"""DataFrame -> DataFrame operators (batch and, where Spark allows, streaming)."""
