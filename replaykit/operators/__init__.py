"""Set-based operators over deliveries, ledgers and evidence."""
