"""Column expressions shared by the transforms, the star schema and the reports."""
