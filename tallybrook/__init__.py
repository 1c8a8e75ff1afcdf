"""tallybrook: batch and streaming analytics jobs written for Spark."""

from tallybrook.session import build_session, session_settings, work_folder

__all__ = ["build_session", "session_settings", "work_folder"]
