"""cirrus: a Spark-native observation pipeline.

Raw JSON observations land in a VARIANT table, are curated into a location
dimension and a typed observation fact, and are turned into answer tables
(batch queries and incrementally maintained states fed by Structured
Streaming). Everything is expressed with the public DataFrame / SQL /
Structured Streaming APIs so that Catalyst and AQE choose the physical plan.
"""

__version__ = "0.1.0"
