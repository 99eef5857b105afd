"""Readers for landed JSON, warehouse tables and selection documents."""
