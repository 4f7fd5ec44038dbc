"""Reading exports, site lists and water tables; writing results."""
