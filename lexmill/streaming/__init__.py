"""Incremental work on arriving pages."""
