"""User-level read queries and the batch pipeline, composed from the operators."""
