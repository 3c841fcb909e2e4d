"""Readers and writers. Raw tables are all text; typing happens in staging."""
