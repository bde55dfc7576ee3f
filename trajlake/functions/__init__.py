"""Part of trajlake."""
