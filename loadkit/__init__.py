"""loadkit: load files with bulk-copy semantics on Spark and prove that the load is right."""

__version__ = "0.1.0"
