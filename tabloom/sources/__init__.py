"""Reading tables, and writing results other jobs read back."""
