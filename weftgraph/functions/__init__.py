"""Ways to combine the messages that reach one vertex."""

from weftgraph.functions.combine import most_frequent, reduced_by

__all__ = ["most_frequent", "reduced_by"]
