"""tessera: DataFrame operators that build and score code-performance datasets on Spark."""
