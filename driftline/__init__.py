"""driftline: origin-destination and street-network flow analytics on PySpark."""
