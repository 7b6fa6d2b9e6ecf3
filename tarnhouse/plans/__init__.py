"""Calendars, silver views, the gold star, entities and metadata-driven loads."""
