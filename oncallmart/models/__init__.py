"""Model jobs: forecasts, risk scores, clusters, anomalies and their records."""
