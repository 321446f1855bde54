"""The supplied tables in the roles of the vendor feeds, and the queries on them."""
