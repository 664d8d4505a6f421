"""The model graph (stage, dimensions, intermediates, facts, marts) and read queries."""
