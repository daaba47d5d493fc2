"""Readers and writers: instruction sources, problem sets, code files, run reports."""
