"""Readers, the event adapter and the synthetic flow generator."""
