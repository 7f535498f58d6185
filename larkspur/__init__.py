"""larkspur: hashtag, bid-log and booking analytics as Spark DataFrame jobs."""

from larkspur.session import drop_scratch, get_session, scratch_path, shared_dir

__all__ = ["get_session", "shared_dir", "scratch_path", "drop_scratch"]
