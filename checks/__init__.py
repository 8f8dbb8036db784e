"""Queries over the driver's tables, their SQL twins, and the views both derive."""
