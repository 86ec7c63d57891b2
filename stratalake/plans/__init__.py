"""The layers, from raw records to the churn-rate report."""
