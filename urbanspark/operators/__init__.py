"""DataFrame operators that are independent of any one table."""
