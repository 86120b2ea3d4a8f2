from rankeval.streaming.ingest import index_stream

__all__ = ["index_stream"]
