"""The tables of the lake: bronze, silver, gold, and the chain that builds them."""
