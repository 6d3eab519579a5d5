"""The supply-chain tables: star schema, staging, marts and analyses."""
