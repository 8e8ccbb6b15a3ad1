"""Reading raw tables and writing results."""
