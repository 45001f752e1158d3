"""tidewire: event analytics over article streams, as Spark DataFrame operators."""

__version__ = "0.1.0"
