"""Reusable DataFrame -> DataFrame building blocks, free of domain names."""
