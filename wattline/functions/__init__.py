"""Column expressions shared by sources, operators and plans."""
