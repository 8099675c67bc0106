"""Foreground audience concurrency on Spark: events to intervals, boundaries, tiers and served answers."""
