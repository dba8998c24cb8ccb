"""Whole jobs: migrate, resume, dry run, control."""
