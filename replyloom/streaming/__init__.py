from .incremental import stream_bad_lines, stream_infer

__all__ = ["stream_bad_lines", "stream_infer"]
