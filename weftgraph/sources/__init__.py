"""Reading graphs from files and tables, and writing results."""
