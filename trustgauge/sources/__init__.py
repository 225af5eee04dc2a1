"""Reading labelled tables and saved errors, writing result tables, intermediate tables."""
