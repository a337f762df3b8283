"""tallyloom: Spark operators for public survey tables and statistical time series."""
