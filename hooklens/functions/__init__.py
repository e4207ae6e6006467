"""Column expressions shared by the batch operators and the streams."""
