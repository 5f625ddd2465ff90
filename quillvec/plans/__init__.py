"""Views over the driver's tables and the registry of named queries."""
