"""Landing files, lake tables and the ledgers of what was processed."""
