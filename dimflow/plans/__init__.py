"""Pipelines that run actions: staging, dimension loads, views and extracts."""
