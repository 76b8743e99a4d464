"""Job order (medallion) and the registered queries."""
