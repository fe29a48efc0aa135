"""Domain stages: silver conform, gold features/forecast/pairs/recommendations,
data quality and reports, and the end-to-end pipeline."""
