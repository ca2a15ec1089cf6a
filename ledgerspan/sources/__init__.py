"""Readers, sinks, lineage and snapshot audit."""
