"""Flat files, vendor extracts and the warehouse tables."""
