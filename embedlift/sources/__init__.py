"""Readers that turn stored exports, pages and change files into records."""
