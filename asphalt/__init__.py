"""Road-risk prioritisation as Spark jobs: where, what and when to intervene."""

__version__ = "0.1.0"
