"""Readers: CSV files, the inbox, recorded API pages and warehouse tables."""
