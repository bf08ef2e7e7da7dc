"""Whole plans: cleaned tables, report views, price series, monthly load."""
