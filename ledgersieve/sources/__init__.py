"""Reading and writing: text landing files, layer tables, cut points."""
