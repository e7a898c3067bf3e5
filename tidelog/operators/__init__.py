"""DataFrame operators over logs, cursors, checkpoints and assignments."""
