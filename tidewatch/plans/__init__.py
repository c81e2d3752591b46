"""Composite plans: registered queries over the bound tables and daily reports."""
