"""Table builders: typed tables, dimensions, facts, features, scores and the refresh that chains them."""
