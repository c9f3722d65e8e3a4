"""zonecast.sources."""
