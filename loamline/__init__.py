"""loamline: a Spark-native analytics engine for layered agricultural data and documents."""

__version__ = "0.1.0"
