"""gaugeworks: fleet-telemetry analytics as plain Spark jobs."""

from gaugeworks.session import checkpoint_dir, configure, local_session

__all__ = ["checkpoint_dir", "configure", "local_session"]
