"""One query per operator over the warehouse tables, and SQL for the same results."""
