"""Query plans over the driver tables: Spark queries and their SQL twins."""
