"""Inventory, purchasing and fulfilment analytics as lazy Spark DataFrame operators."""
