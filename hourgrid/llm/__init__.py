"""Training-data operators; see registry.py for their queries."""
