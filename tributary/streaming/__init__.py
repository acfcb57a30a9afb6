"""Streaming forms of the change-log steps; every job is restartable from its checkpoint."""
