"""Reading and writing tables, and what is known about their partitions."""
