"""Registered queries over the star schema, each with the SQL that checks it."""
