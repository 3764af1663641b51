"""Reading and writing: driver tables, partitioned warehouse tables, saved models."""
