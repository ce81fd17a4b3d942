"""How operators are put together: layers, the batch run and the registered queries."""
