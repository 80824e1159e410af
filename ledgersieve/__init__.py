"""Find, explain and isolate bad records in related tables, as Spark batch jobs."""
