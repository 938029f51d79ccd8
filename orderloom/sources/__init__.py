"""Reading raw and stored tables, and writing them."""
