"""Readers, decoders and generators."""
