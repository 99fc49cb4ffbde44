"""Composed queries (the reference's reports, views, dashboard and batch jobs)."""
