"""Part of spotweave."""
