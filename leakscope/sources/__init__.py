"""Readers and writers: messages (batch and stream), tables, test fixtures."""
