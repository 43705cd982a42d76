"""How frames are combined: sized joins, test-table bindings and the layered jobs."""
