"""farebox: trip-record analytics as Spark DataFrame and Structured Streaming operators."""

from farebox.session import build_session, pin_settings, scratch_path, shared_dir

__all__ = ["build_session", "pin_settings", "scratch_path", "shared_dir"]
