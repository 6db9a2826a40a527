"""Repeated polling as a stream of batches into the keyed tables."""
