"""Table, text, graph, stream and model analytics written on the Spark DataFrame API."""

__version__ = "0.1.0"
