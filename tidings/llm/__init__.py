"""Operators that prepare text for model training: one module per problem, no state shared with the core."""
