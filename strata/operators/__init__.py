"""DataFrame -> DataFrame operators: SCD2 merge (scd2), ranks and positions (rank),
data-quality rules and quarantine (quality)."""
