"""Readers: calendar, landed files, extracts, recorded labels, seeds, sheets and streams."""
