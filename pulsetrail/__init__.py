"""User-behaviour and entity-graph analytics as plain PySpark DataFrame operators."""
