from tidemark.streaming.migrate import file_stream, finish_stream, pause_stream, stream_job

__all__ = ["file_stream", "finish_stream", "pause_stream", "stream_job"]
