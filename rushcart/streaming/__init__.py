"""Running forms of the batch operators."""
