"""Column functions: text, parsing, value maps and metrics. Built-in expressions only."""
