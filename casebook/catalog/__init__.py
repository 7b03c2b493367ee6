"""Every registered query and the SQL that checks it."""
