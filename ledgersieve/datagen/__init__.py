"""Clean purchase orders, labelled error injection and the answer key."""
