"""Reading captured pages, reading and writing results."""
