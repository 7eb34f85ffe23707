"""The jobs applied to the test tables, their SQL twins, and plan inspection."""
