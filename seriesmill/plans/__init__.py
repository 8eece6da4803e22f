"""Layer by layer: ETL, training and scoring."""
