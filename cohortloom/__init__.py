"""Study-design analytics on Spark: DataFrame-to-DataFrame operators over experiment metadata."""
