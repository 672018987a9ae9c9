"""Gazetteer analytics on Spark: places, names, time, space, links and their search, as DataFrame operators."""
