"""marquee — a Spark-native catalog and analytics engine.

Everything is expressed with DataFrames, Spark SQL and Structured
Streaming; Python only appears as Arrow-batched helpers where Spark has
no built-in form.
"""

from marquee.session import build_session, prepare  # noqa: F401

__version__ = "0.1.0"
