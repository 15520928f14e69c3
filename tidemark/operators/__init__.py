"""Pure ``DataFrame -> DataFrame`` operators (no writes, no driver-side data)."""
