"""Readers: feed files, layer tables, warehouse tables, price histories, uploads."""
