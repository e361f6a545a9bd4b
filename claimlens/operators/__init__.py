"""Relational building blocks shared by the reports."""
