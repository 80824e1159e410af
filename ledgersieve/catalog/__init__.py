"""The runnable queries over a folder of tables, and the same results stated in SQL."""
