"""tidal: Spark-native daily-series forecasting and event clustering.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, window functions, Spark ML and Structured Streaming. Fitted state
(scaler statistics, vocabularies, centroids, coefficients) is small and bounded
by the model size, never by the data size.
"""

__version__ = "0.1.0"
