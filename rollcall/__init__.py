"""rollcall: a real-time member roll on PySpark.

JSON log envelopes are filtered, routed and parsed; member, registration and
payment facts are joined in event-time windows, looked up against dimension
tables and folded into one wide row per member.
"""

__version__ = "0.1.0"
