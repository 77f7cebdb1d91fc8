"""Cash fares against loyalty points, as Spark DataFrame operators."""
