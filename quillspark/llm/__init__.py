"""Training-data operators: each module holds one operator, ``catalogue`` their queries."""
