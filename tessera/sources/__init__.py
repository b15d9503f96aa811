"""Reading and writing tables of entities, links, predictions and run records."""
