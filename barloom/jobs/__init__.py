"""Jobs that chain operators over the warehouse tables."""
