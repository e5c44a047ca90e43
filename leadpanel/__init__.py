"""leadpanel: property lead scoring as ordinary Spark DataFrame operators."""
