"""The layers: staging, quarantine, silver, profiling, evaluation, monitoring."""
