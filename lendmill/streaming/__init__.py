from lendmill.streaming.messages import read_message_stream, stream_result, write_stream

__all__ = ["read_message_stream", "stream_result", "write_stream"]
