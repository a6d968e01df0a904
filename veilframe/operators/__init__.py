"""Recipe compilation: selectors, predicates, actions and geometry as Spark columns."""
