"""Operators for preparing training data at scale; see ``catalogue`` for their queries."""
