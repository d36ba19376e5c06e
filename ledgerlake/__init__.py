"""ledgerlake: spending-disclosure analytics expressed as Spark DataFrame plans."""
