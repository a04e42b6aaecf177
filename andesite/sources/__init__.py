"""Scans: landed JSON responses, document collections and literal relations."""
