"""The end-to-end job, and the catalogue of checked queries."""
