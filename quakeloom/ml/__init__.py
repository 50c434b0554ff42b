"""MLlib pipelines: risk regression and regional clusters."""
