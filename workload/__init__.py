"""The registered queries and the SQL that checks each of them."""
