"""Building blocks: run settings, edge layout, skew-safe joins, degrees, message passing, triangles."""
