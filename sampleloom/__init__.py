"""Sample processing and embedding-table maintenance as Spark jobs."""

from sampleloom.session import build_session, checkpoint_dir, settled

__all__ = ["build_session", "checkpoint_dir", "settled"]
