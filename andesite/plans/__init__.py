"""The bronze, silver and gold steps, and the flow through all of them."""
