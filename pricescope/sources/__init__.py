"""Table sources: test-data derivations, warehouse tables, landed feeds."""
