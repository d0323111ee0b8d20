"""Column expressions shared by the load jobs and the reports."""
