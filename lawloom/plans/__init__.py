"""Jobs wired from the operators: the document flow, and the checked queries."""
