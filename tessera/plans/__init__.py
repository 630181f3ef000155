"""Queries over the driver's tables, one for each operator; importing the modules registers them."""
