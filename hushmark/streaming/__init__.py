from hushmark.streaming.redact import checkpoint_path, redact_stream, start_redaction

__all__ = ["checkpoint_path", "redact_stream", "start_redaction"]
