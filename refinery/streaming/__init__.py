"""Entity pipelines on a stream of payload files, and the latest rows of a stream."""

from refinery.streaming.merge import merge_batch, merge_stream
from refinery.streaming.refine import read_stream, refine_stream, write_stream

__all__ = ["merge_batch", "merge_stream", "read_stream", "refine_stream", "write_stream"]
