"""Query catalog: named Spark queries over the driver tables and their SQL oracles."""
