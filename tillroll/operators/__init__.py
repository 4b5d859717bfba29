"""Reusable relational building blocks for the views."""
