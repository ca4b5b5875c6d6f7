"""Entity-relationship analytics as Spark plans."""
