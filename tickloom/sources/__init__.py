"""Readers and writers. Readers only build plans, except for the small header probe that
finds a file's separator."""
