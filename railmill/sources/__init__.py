"""Readers, feed splitting and typing, and table writers."""
