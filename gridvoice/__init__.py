"""Customer-complaint analytics for an electricity network, as Spark DataFrame operators."""
