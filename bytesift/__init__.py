"""Exact byte-pattern search over tables and streams of texts, on PySpark."""

from bytesift.operators import *  # noqa: F403
from bytesift.operators import __all__ as _operators
from bytesift.sources import *  # noqa: F403
from bytesift.sources import __all__ as _sources
from bytesift.streaming import *  # noqa: F403
from bytesift.streaming import __all__ as _streaming

__all__ = [*_operators, *_sources, *_streaming]
