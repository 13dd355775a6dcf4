"""DataFrame operators over issues, change history and synchronisation runs."""
