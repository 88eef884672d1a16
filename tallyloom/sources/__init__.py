"""Readers and decoders that turn files and text lines into frames."""
