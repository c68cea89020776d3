"""Reading accident files and prepared tables, writing results."""
