"""Incremental (partition-wise) processing; there is no event-time streaming here."""
