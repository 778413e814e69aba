"""Scans: region catalogue, landed documents, warehouse tables, config."""
