"""Part of gradeloom; see the README for the inventory."""
