"""Column expressions shared by operators and stages."""
