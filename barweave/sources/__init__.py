"""Readers and writers: bar files, derived bar sets, message topics."""
