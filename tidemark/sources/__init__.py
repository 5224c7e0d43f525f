"""Reading landed files, the panel and vintage stores, and the indicator registry."""
