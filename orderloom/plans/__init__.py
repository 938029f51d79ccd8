"""The datasets: retail orders, order-to-cash, receivables, and their declared checks."""
