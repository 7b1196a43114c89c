"""Scans: log lines, JSON records and tables, batch or streaming."""
