"""Feature presets, derived relations and the query catalogue."""
