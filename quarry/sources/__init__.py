"""Readers and writers: driver tables, JSON lines with line numbers, pipeline sinks."""
