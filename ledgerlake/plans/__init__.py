"""The warehouse build, the supplied tables seen as a bank, and the query catalog."""
