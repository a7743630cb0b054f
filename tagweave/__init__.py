"""Set-constraint analytics on Spark: declarative programs over tagged, related entities."""
