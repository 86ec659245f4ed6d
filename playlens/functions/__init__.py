"""Column expressions shared by the readers, operators and streams."""
