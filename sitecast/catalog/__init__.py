"""Every query with the SQL that checks it."""
