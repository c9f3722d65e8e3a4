"""zonecast.operators."""
