"""Frame-to-frame operators. None runs an action, so each can be part of a larger plan."""
