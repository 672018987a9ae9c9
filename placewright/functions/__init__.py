"""Part of placewright."""
