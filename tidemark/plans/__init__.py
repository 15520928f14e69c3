"""Stage plans (the only writers), table store, and the registered queries."""
