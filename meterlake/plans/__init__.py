"""Staging views, dimensions, fact, marts, monitoring, dashboards and jobs."""
