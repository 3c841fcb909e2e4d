"""The domain pipeline: edges, persons, seeds, walk, marts, graph."""
