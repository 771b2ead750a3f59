"""clickscope: user-behaviour and advertising analytics over clickstream data, on Spark.

Every public operator is a function ``DataFrame(s) + parameters -> DataFrame``. Operators
never trigger an action and never pull rows to the driver; batch and Structured Streaming
share the same column logic.
"""

from clickscope.params import TaskParams
from clickscope.runtime import build_session, checkpoint_root

__all__ = ["TaskParams", "build_session", "checkpoint_root"]
