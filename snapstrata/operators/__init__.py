"""Relational operators: ``DataFrame`` in, ``DataFrame`` out, nothing executed."""
