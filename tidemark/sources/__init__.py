"""Reading and writing the event lake and the warehouse tables."""
