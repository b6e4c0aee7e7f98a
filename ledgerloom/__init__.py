"""Set-at-a-time operators over the ledger of a database-migration tool."""
