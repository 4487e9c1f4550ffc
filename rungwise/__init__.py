"""Table preparation, classifier training and scaling studies on Spark."""
