"""Every operator as a query over the given test tables, with its SQL counterpart."""
