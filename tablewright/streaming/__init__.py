"""Streaming form of batch scoring: apply a fitted model to files as they arrive.

The reference itself has no streams; this only lets O54/O03 (predict, write
predictions) run on a folder that keeps receiving new test files.
"""

from tablewright.streaming.scoring import score_stream

__all__ = ["score_stream"]
