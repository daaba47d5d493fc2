"""Operators for large training corpora: removal of copies, filters, mixing, formatting, output."""
