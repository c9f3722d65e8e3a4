"""zonecast.streaming."""
