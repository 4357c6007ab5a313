"""Graph analytics over labelled source-code datasets, expressed as Spark plans."""

__version__ = "0.1.0"
