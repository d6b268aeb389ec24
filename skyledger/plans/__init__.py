"""Whole jobs: capture to bronze, bronze to silver, silver to gold."""
