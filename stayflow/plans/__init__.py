"""The unit-activity build and the queries over the driver tables."""
