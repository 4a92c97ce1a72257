"""Event-time replay and windows."""
